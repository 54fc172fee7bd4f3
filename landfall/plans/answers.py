"""Questions the star answers.

Arrivals are counted by port and country before anything is joined.  A port or a
country with a large share of the rows is thereby reduced in each task to a few
counts, and the code lists meet counts, not arrivals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.bitmaps import bitmap_place, bits_of, bits_set, code_number, merged_bits
from landfall.operators.joins import join_fact_country, join_fact_port, join_lookup


def arrivals_by_port_and_country(clean: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """Counts of the fact's rows, straight from the extract."""
    counted = (
        clean.where(F.col("arrdate").isNotNull())
        .groupBy("i94port", "i94cit")
        .agg(F.count(F.lit(1)).alias("entries"))
    )
    return known_places(counted, countries, ports)


def known_places(counted: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """``entries`` by port and country code, with what the lists say; unknown ones drop out."""
    known = join_fact_port(join_fact_country(counted, countries), ports)
    return known.select(
        F.col("i94_port").alias("airport_id"),
        F.col("i94_airport_name").alias("airport_name"),
        F.col("i94_airport_state").alias("airport_state"),
        F.col("i94_cit").alias("country_code"),
        "entries",
    )


def nationalities_from_extract(clean: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """How many nationalities, and people, came through each airport."""
    return by_airport(arrivals_by_port_and_country(clean, countries, ports))


def by_airport(arrivals: DataFrame) -> DataFrame:
    return (
        arrivals.groupBy("airport_id", "airport_name", "airport_state")
        .agg(
            F.sum("entries").alias("entries"),
            F.count_distinct("country_code").alias("nationalities"),
        )
    )


def nationalities_by_airport(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """The same from the fact table; names are looked up for the grouped rows."""
    grouped = (
        fact.groupBy("airport_id", "country_code")
        .agg(F.count(F.lit(1)).alias("entries"))
        .groupBy(F.col("airport_id").alias("fact_airport"))
        .agg(F.sum("entries").alias("entries"), F.count("country_code").alias("nationalities"))
    )
    return join_lookup(grouped, airports, "fact_airport", "airport_id").select(
        "airport_id", "airport_name", "airport_state", "entries", "nationalities"
    )


def nationality_bits(fact: DataFrame, *more: str) -> DataFrame:
    """Arrivals and the set of country codes of each airport, and of each value of ``more``, in a form that can be merged.

    A set is bitmaps of 8 bytes, one for each 64 codes that has any, so a row takes the same space however
    many arrivals it stands for.  Arrivals are merged in each task before they are shuffled, once.
    """
    coded = fact.select("airport_id", *more, code_number(F.col("country_code")).alias("_code"))
    place = F.coalesce(bitmap_place(F.col("_code")), F.lit(0).cast("bigint")).alias("place")
    return coded.groupBy("airport_id", *more, place).agg(F.count(F.lit(1)).alias("entries"), bits_of(F.col("_code")).alias("bits"))


def nationalities_from_bits(bits: DataFrame, airports: DataFrame) -> DataFrame:
    """``nationalities_by_airport`` from any number of ``nationality_bits``, each code counted once over all of them."""
    merged = bits.groupBy("airport_id", "place").agg(F.sum("entries").alias("entries"), merged_bits(F.col("bits")).alias("bits"))
    grouped = merged.groupBy(F.col("airport_id").alias("fact_airport")).agg(
        F.sum("entries").alias("entries"), F.sum(bits_set(F.col("bits"))).alias("nationalities")
    )
    return join_lookup(grouped, airports, "fact_airport", "airport_id").select(
        "airport_id", "airport_name", "airport_state", "entries", "nationalities"
    )


def top_airports(fact: DataFrame, airports: DataFrame, k: int) -> DataFrame:
    """The ``k`` most used airports, equal counts by id."""
    used = fact.groupBy(F.col("airport_id").alias("fact_airport")).agg(F.count(F.lit(1)).alias("entries"))
    named = join_lookup(used, airports, "fact_airport", "airport_id")
    return (
        named.select("airport_id", "airport_name", "airport_state", "entries")
        .orderBy(F.desc("entries"), "airport_id")
        .limit(k)
    )


def arrivals_on(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Facts of the days in ``days``, a time dimension cut down to some of them.

    Days are met by year and month, too: of a fact in folders of months Spark then reads only those the
    days are in, which it finds out while it runs.
    """
    wanted = days.select(F.col("arrival_ts").alias("_day"), F.col("year").alias("_year"), F.col("month").alias("_month"))
    same = (
        (F.col("arrival_year") == F.col("_year"))
        & (F.col("arrival_month") == F.col("_month"))
        & (F.col("arrival_time") == F.col("_day"))
    )
    return fact.join(wanted, same, "left_semi")
