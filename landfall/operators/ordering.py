"""Total orders and previews.

Each order is completed by the table's other columns: rows are range-partitioned
on the whole list, so a value held by much of the table is split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def total_order(df: DataFrame, *first: str) -> DataFrame:
    return df.orderBy(*first, *[c for c in df.columns if c not in first])


def order_admissions(admissions: DataFrame) -> DataFrame:
    return total_order(admissions, "country_code")


def order_countries(countries: DataFrame) -> DataFrame:
    return total_order(countries, "country_name")


def order_airports(airports: DataFrame) -> DataFrame:
    return total_order(airports, "airport_name")


def order_fact(fact: DataFrame) -> DataFrame:
    return total_order(fact, "arrival_time")


def head_n(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of an ordered table, for looking at."""
    return df.limit(n)
