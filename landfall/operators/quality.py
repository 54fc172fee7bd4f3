"""Data-quality checks: bad keys and row counts, in one pass a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landfall.schemas import KEYS


def bad_key_predicate(df: DataFrame, keys: Sequence[str]) -> Column:
    """True where any key is null, or is text and empty; blanks are not trimmed."""
    kinds = dict(df.dtypes)

    def bad(key: str) -> Column:
        missing = F.col(key).isNull()
        return missing | (F.col(key) == "") if kinds[key] == "string" else missing

    return reduce(Column.__or__, [bad(key) for key in keys])


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_bad_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.agg(F.count_if(bad_key_predicate(df, keys)).alias("bad_key_count"))


def dq_verdict(bad_keys: Column, rows: Column, compat: bool = False) -> Column:
    """``NOK`` for a bad key or an empty table; ``compat`` passes an empty table."""
    failed = bad_keys > 0 if compat else (bad_keys > 0) | (rows < 1)
    return F.when(failed, "NOK").otherwise("OK")


def check_table(
    df: DataFrame,
    table: str,
    keys: Sequence[str] | None = None,
    round_ts: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """One row: table, row count, bad-key count, verdict, after ``round_ts`` if given."""
    keys = keys or KEYS[table]
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad_key_predicate(df, keys)).alias("bad_key_count"),
    )
    stamp = [F.lit(round_ts).alias("round_ts")] if round_ts else []
    verdict = dq_verdict(F.col("bad_key_count"), F.col("row_count"), compat)
    return counted.select(
        *stamp, F.lit(table).alias("table_name"), "row_count", "bad_key_count", verdict.alias("status")
    )


class Measured:
    """Row and bad-key counts of tables, taken while they are written instead of by reading them again.

    Counts are observed in the tasks that write, after the last shuffle: what a lost task
    counted is forgotten with it, and what is run again counts once.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def of(self, table: str, keys: Sequence[str] | None = None) -> Callable[[DataFrame], DataFrame]:
        """To be put on the way of a table's rows; ``report`` has them once the table is written."""

        def observe(df: DataFrame) -> DataFrame:
            self._seen[table] = seen = Observation(f"{table} {uuid.uuid4().hex}")
            bad = F.count_if(bad_key_predicate(df, keys or KEYS[table]))
            return df.observe(seen, F.count(F.lit(1)).alias("row_count"), bad.alias("bad_key_count"))

        return observe

    def counts(self) -> list[tuple[str, int, int]]:
        return [(name, seen.get["row_count"], seen.get["bad_key_count"]) for name, seen in self._seen.items()]

    def report(self, spark: SparkSession, round_ts: str, compat: bool = False) -> DataFrame:
        """The same rows as ``dq_report`` over the written tables."""
        rows = spark.createDataFrame(self.counts(), "table_name string, row_count bigint, bad_key_count bigint")
        verdict = dq_verdict(F.col("bad_key_count"), F.col("row_count"), compat)
        return rows.select(F.lit(round_ts).alias("round_ts"), "*", verdict.alias("status"))


def check_list(df: DataFrame, name: str, key: str | Column, round_ts: str) -> DataFrame:
    """One row: list, codes, codes listed more than once, verdict; such a code multiplies the rows it meets.

    ``key`` is the column, or what it is compared by.  A null code meets nothing.
    """
    codes = df.groupBy((F.col(key) if isinstance(key, str) else key).alias("code")).agg(F.count(F.lit(1)).alias("listed"))
    doubled = F.col("code").isNotNull() & (F.col("listed") > 1)
    counted = codes.agg(F.coalesce(F.sum("listed"), F.lit(0)).alias("row_count"), F.count_if(doubled).alias("bad_key_count"))
    verdict = dq_verdict(F.col("bad_key_count"), F.col("row_count"))
    return counted.select(
        F.lit(round_ts).alias("round_ts"), F.lit(name).alias("table_name"), "row_count", "bad_key_count",
        verdict.alias("status"),
    )


def dq_report(
    tables: Mapping[str, DataFrame],
    round_ts: str,
    compat: bool = False,
    lists: Mapping[str, tuple[DataFrame, str | Column]] | None = None,
) -> DataFrame:
    """One row a table for this round, and one for each code list given with its key column."""
    rows = [check_table(df, name, round_ts=round_ts, compat=compat) for name, df in tables.items()]
    rows += [check_list(df, name, key, round_ts) for name, (df, key) in (lists or {}).items()]
    return reduce(DataFrame.unionByName, rows)


def dq_record(report: DataFrame, tables: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """The report as one row a round: ``<table>_count`` and, under the table's name, its verdict."""

    def of_table(name: str, column: str) -> Column:
        return F.max(F.when(F.col("table_name") == name, F.col(column)))

    columns = [
        value
        for name in tables
        for value in (of_table(name, "row_count").alias(f"{name}_count"), of_table(name, "status").alias(name))
    ]
    return report.groupBy("round_ts").agg(*columns)
