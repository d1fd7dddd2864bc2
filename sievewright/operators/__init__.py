"""Relational operators, the feature and model steps, and batch inference."""
