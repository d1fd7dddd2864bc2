"""Whole flows: evaluation, training, prediction."""
