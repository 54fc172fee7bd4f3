"""Whole tables, reports and answers, put together from the operators."""
