"""Operators for building training data: mixing, filtering, near-duplicates, extraction, scoring, token files."""
