"""Operators for large text corpora that are to become training data."""
