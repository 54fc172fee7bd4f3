"""Distinct rows of the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.dates import whole_day
from landfall.operators.projections import (
    project_admissions,
    project_airports,
    project_countries,
    project_time,
    with_arrival_time,
)


def distinct_admissions(extract: DataFrame) -> DataFrame:
    return project_admissions(extract).distinct()


def distinct_countries(countries_with_iso: DataFrame) -> DataFrame:
    return project_countries(countries_with_iso).distinct()


def distinct_airports(ports: DataFrame) -> DataFrame:
    return project_airports(ports).distinct()


def distinct_time(extract: DataFrame) -> DataFrame:
    """Days first, parts second: only the few distinct days are shuffled and taken apart."""
    days = extract.select(whole_day(F.col("arrdate")).alias("arrdate")).distinct()
    return project_time(with_arrival_time(days))


def distinct_fact(fact: DataFrame) -> DataFrame:
    """Fact rows without their id, each once.

    With the id every row is unique already, so the fact build itself has no distinct.
    """
    return fact.drop("immigration_id").distinct()
