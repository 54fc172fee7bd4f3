"""The arrivals fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.dates import departure_ts
from landfall.functions.keys import natural_id, run_id
from landfall.operators.joins import join_fact_country, join_fact_port, join_fact_time
from landfall.operators.projections import project_fact, with_arrival_time
from landfall.plans.dimensions import dim_time


def star_join(clean: DataFrame, countries: DataFrame, ports: DataFrame, time: DataFrame) -> DataFrame:
    """The extract with all three lists, the time dimension included."""
    timed = with_arrival_time(clean)
    return join_fact_time(join_fact_port(join_fact_country(timed, countries), ports), time)


def fact_immigrations(
    clean: DataFrame,
    countries: DataFrame,
    ports: DataFrame,
    null_departure: bool = False,
    stable_ids: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row an arrival whose day, port and country of citizenship are all known.

    Year and month come from the arrival day itself, which is what a join with the
    time dimension would look up, so that join is left out; like the join, the
    filter drops arrivals without a day.  ``carry`` names further extract columns to keep.
    """
    arrived = with_arrival_time(clean.where(F.col("arrdate").isNotNull())).withColumns({
        "arrival_year": F.year("arrival_time"),
        "arrival_month": F.month("arrival_time"),
        "departure_date": departure_ts(F.col("depdate"), null_departure),
    })
    arrived = arrived.withColumn("immigration_id", natural_id(arrived) if stable_ids else run_id())
    return project_fact(join_fact_port(join_fact_country(arrived, countries), ports), carry)


def fact_by_time_join(clean: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """The same fact through the written-out star join, kept to check the shorter build."""
    joined = star_join(clean, countries, ports, dim_time(clean))
    return project_fact(joined.withColumns({
        "immigration_id": natural_id(joined),
        "arrival_year": F.col("year"),
        "arrival_month": F.col("month"),
        "departure_date": departure_ts(F.col("depdate")),
    }))
