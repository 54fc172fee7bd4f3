"""The four dimensions.  ``ordered`` asks for the total order; a layout on disk does not need it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landfall.operators.distinct import (
    distinct_admissions,
    distinct_airports,
    distinct_countries,
    distinct_time,
)
from landfall.operators.joins import join_country_iso
from landfall.operators.ordering import order_admissions, order_airports, order_countries


def dim_admissions(clean: DataFrame, ordered: bool = False) -> DataFrame:
    """Admissions, by country of residence."""
    table = distinct_admissions(clean)
    return order_admissions(table) if ordered else table


def dim_countries(countries: DataFrame, iso: DataFrame, ordered: bool = False) -> DataFrame:
    """Countries that have an ISO entry."""
    table = distinct_countries(join_country_iso(countries, iso))
    return order_countries(table) if ordered else table


def dim_airports(ports: DataFrame, ordered: bool = False) -> DataFrame:
    table = distinct_airports(ports)
    return order_airports(table) if ordered else table


def dim_time(clean: DataFrame) -> DataFrame:
    """One row for each day of arrival."""
    return distinct_time(clean)
