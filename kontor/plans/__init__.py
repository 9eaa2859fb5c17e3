"""Whole chains put together from operators."""
