"""Scalar functions: each takes and returns Columns."""
