"""Operators on record, pair and label tables."""
