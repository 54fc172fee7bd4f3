"""Inner equi-joins of many rows with a code list.

How a list meets the rows is left to Spark, which broadcasts it below the threshold that
``landfall.session`` sets and knows its size from its files or from what it has read.
Building a join runs no job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.keys import as_integer, as_number

AsKey = Callable[[Column], Column]


def _as_it_is(value: Column) -> Column:
    return value


def join_lookup(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, as_key: AsKey = _as_it_is
) -> DataFrame:
    """``rows`` with the matching ``lookup`` columns; keys are compared through ``as_key``."""
    return rows.join(lookup, as_key(rows[row_key]) == as_key(lookup[lookup_key]))


def join_lookup_filtered(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, as_key: AsKey = _as_it_is
) -> DataFrame:
    """``join_lookup`` where many rows have no entry in a list too long to broadcast.

    Spark then makes a Bloom filter of the list's keys while it runs, and drops nearly all rows without an
    entry before they are shuffled.  It does so for lists it deems cut down by a condition: here, that there
    is a key at all, which an inner join asks anyway.  ``landfall.session`` sets from which size of rows on, and
    up to which size of list, that pays.
    """
    known = lookup.where(F.length(F.col(lookup_key).cast("string")) >= 0)
    return join_lookup(rows, known, row_key, lookup_key, as_key)


def frequent_keys(keyed: DataFrame, rows_per_task: int) -> DataFrame:
    """Keys on more rows than one task should get, with the number of tasks each is to be spread over.

    Rows are counted in each task before they are shuffled; of ``n`` rows at most
    ``n / rows_per_task`` keys remain.
    """
    counted = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") > rows_per_task).select(
        F.col("_key").alias("_frequent"), F.ceil(F.col("_rows") / rows_per_task).alias("_tasks")
    )


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    row_key: str,
    lookup_key: str,
    record_id: str,
    rows_per_task: int,
    as_key: AsKey = _as_it_is,
) -> DataFrame:
    """``join_lookup`` for a list too long to broadcast: shuffled on the key and, for frequent keys only, a salt.

    The caller names the column that tells rows of a key apart.  The salt is a hash of
    it, so rows that carry nothing else beside the key are spread, too, and a task that
    is run again sends them the same way.  The list row of a frequent key is
    copied to each of its salts.
    """
    if record_id not in rows.columns or record_id == row_key:
        raise ValueError(f"no column {record_id} apart from the key to spread rows by")
    left = rows.withColumn("_key", as_key(F.col(row_key)))
    right = lookup.withColumn("_lookup_key", as_key(F.col(lookup_key)))
    frequent = frequent_keys(left, rows_per_task)
    tasks = F.coalesce(F.col("_tasks"), F.lit(1))
    left = (
        left.join(frequent, F.col("_key") == F.col("_frequent"), "left")
        .withColumn("_salt", F.pmod(F.when(F.col("_tasks") > 1, F.xxhash64(record_id)).otherwise(0), tasks))
        .drop("_frequent", "_tasks")
    )
    right = (
        right.join(frequent, F.col("_lookup_key") == F.col("_frequent"), "left")
        .withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1)))
        .drop("_frequent", "_tasks")
    )
    met = (F.col("_key") == F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt"))
    return left.join(right, met).drop("_key", "_lookup_key", "_salt", "_lookup_salt")


def join_country_iso(countries: DataFrame, iso: DataFrame) -> DataFrame:
    """Country list with its ISO entry; countries whose ISO number is unknown drop out."""
    return join_lookup(countries, iso, "iso_country_code", "country_code", as_integer)


def join_fact_country(extract: DataFrame, countries: DataFrame) -> DataFrame:
    """Extract with country of citizenship; the extract has the code as a number, the list as text."""
    return join_lookup(extract, countries, "i94cit", "i94_cit", as_number)


def join_fact_port(extract: DataFrame, ports: DataFrame) -> DataFrame:
    """Extract with port of entry, case exact."""
    return join_lookup(extract, ports, "i94port", "i94_port")


def join_fact_time(extract: DataFrame, time: DataFrame) -> DataFrame:
    """Extract with the time dimension, on the arrival timestamp."""
    return join_lookup(extract, time, "arrival_time", "arrival_ts")
