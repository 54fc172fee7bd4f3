"""Column selection and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.dates import date_parts, day_to_ts
from landfall.schemas import ADMISSIONS, AIRPORTS, COUNTRY_DIM, FACT


def project(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """The columns named on the right, under the names on the left."""
    return df.select([F.col(old).alias(new) for new, old in renames.items()])


def derive_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def with_arrival_time(extract: DataFrame) -> DataFrame:
    return derive_column(extract, "arrival_time", day_to_ts(F.col("arrdate")))


def project_admissions(extract: DataFrame) -> DataFrame:
    return project(extract, ADMISSIONS)


def project_countries(countries_with_iso: DataFrame) -> DataFrame:
    # The ISO list's own code column is not kept, so the names in the mapping are unambiguous.
    return project(countries_with_iso, COUNTRY_DIM)


def project_airports(ports: DataFrame) -> DataFrame:
    return project(ports, AIRPORTS)


def project_time(extract: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Arrival timestamp and its parts, one row per input row; needs ``arrival_time``."""
    ts = F.col("arrival_time")
    parts = [part.alias(name) for name, part in date_parts(ts).items()]
    return extract.select(ts.alias("arrival_ts"), *parts, *carry)


def project_fact(joined: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return project(joined, FACT | {name: name for name in carry})
