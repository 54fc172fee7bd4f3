"""What the inner joins leave out, and facts whose country has no dimension row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.keys import as_number


def dropped_rows(clean: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """One row: arrivals in, kept, and dropped for lack of a day, a country or a port.

    An arrival lacking several things is counted under each.  Rows are counted by
    port and country first; the lists, each code once, meet the counts.
    """
    counted = clean.groupBy("i94port", "i94cit").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("arrdate").isNull()).alias("undated")
    )
    known_countries = countries.select(as_number(F.col("i94_cit")).alias("known_country")).distinct()
    known_ports = ports.select(F.col("i94_port").alias("known_port")).distinct()
    seen = counted.join(
        known_countries, F.col("i94cit") == F.col("known_country"), "left"
    ).join(known_ports, F.col("i94port") == F.col("known_port"), "left")
    no_country, no_port = F.col("known_country").isNull(), F.col("known_port").isNull()

    def total(value, when=F.lit(True)):
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0).cast("bigint"))

    return seen.agg(
        total(F.col("n")).alias("source_rows"),
        total(F.col("n") - F.col("undated"), ~no_country & ~no_port).alias("kept_rows"),
        total(F.col("undated")).alias("no_arrival_day"),
        total(F.col("n"), no_country).alias("unknown_country"),
        total(F.col("n"), no_port).alias("unknown_port"),
    )


def orphan_fact_countries(fact: DataFrame, countries: DataFrame) -> DataFrame:
    """Country codes of the fact that the countries dimension lacks, with their row counts."""
    codes = fact.groupBy("country_code").agg(F.count(F.lit(1)).alias("fact_rows"))
    return codes.join(countries.select("country_code"), "country_code", "left_anti")
