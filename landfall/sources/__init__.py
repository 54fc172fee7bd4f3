"""Typed, lazy readers."""
