"""Sievewright: dataset-scale text screening on Spark.

Cleaning, label handling, batch inference, text features, a weighted text
classifier with threshold decisions, and quality reports. Everything is a
DataFrame transformation; Python runs only at the inference boundary.
"""

__version__ = "0.1.0"
