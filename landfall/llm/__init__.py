"""Operators for cleaning and encoding text corpora."""
