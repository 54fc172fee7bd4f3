"""Rows near each other in two respects put near each other in files, so that readers of either skip most of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.joins import join_lookup
from landfall.operators.numbering import dense_numbers

BITS = 16
# Shifts and masks that leave room for another bit after each of 16.
SPREADING = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def spread_bits(value: Column) -> Column:
    """A number below 2**16 with a free bit after each of its own."""
    value = value.cast("bigint")
    for shift, mask in SPREADING:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def interleaved(one: Column, other: Column) -> Column:
    """The bits of two numbers below 2**16 in turn: numbers near in both are mostly near in this one."""
    return F.shiftleft(spread_bits(one), 1).bitwiseOR(spread_bits(other))


def scaled(value: Column, values: Column) -> Column:
    """0 .. values - 1 stretched over 16 bits."""
    return F.floor(value * (1 << BITS) / F.greatest(values, F.lit(1)))


def write_clustered(fact: DataFrame, path: str, rows_per_group: int | None = None) -> None:
    """The fact in folders of month; within a month airport and day go together, interleaved bit by bit.

    Files are cut from one order over the whole table, so a month with much of the data has many
    of them, and an airport with much of the data too; each has few airports and days.  Airports are placed by their dense number,
    which follows their ids, so statistics of files and row groups tell which to skip.
    """
    places = dense_numbers(fact.select(F.col("airport_id").alias("_airport")))
    last = places.agg(F.max("number")).first()[0] or 0
    rows = join_lookup(fact, places, "airport_id", "_airport")
    day = scaled(F.dayofmonth("arrival_time") - 1, F.lit(31))
    rows = rows.withColumn("_place", interleaved(scaled(F.col("number"), F.lit(last + 1)), day)).drop("_airport", "number")
    month = ["arrival_year", "arrival_month"]
    dealt = rows.repartitionByRange(*month, "_place", "immigration_id").sortWithinPartitions(*month, "_place", "airport_id").drop("_place")
    writer = dealt.write.mode("overwrite").partitionBy(*month)
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    writer.parquet(path)
