"""Keeping the fact table current as extracts arrive."""
