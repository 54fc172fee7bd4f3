"""Parquet and CSV output."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how a run's start time is written.
RUN_FORMAT = "%Y-%m-%d-%H-%M-%S-%f"


def run_stamp(started: datetime) -> str:
    return started.strftime(RUN_FORMAT)


def run_path(base: str, table: str, stamp: str) -> str:
    """Each run has a folder of its own, readable as a partition column ``run``."""
    return f"{base.rstrip('/')}/run={stamp}/{table}"


Observe = Callable[[DataFrame], DataFrame]


def _unobserved(df: DataFrame) -> DataFrame:
    return df


def write_overwrite(df: DataFrame, path: str, observe: Observe = _unobserved) -> None:
    """Replaces what is there; ``observe`` may look at the rows on their way."""
    observe(df).write.mode("overwrite").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    order: Sequence[str] = (),
    append: bool = False,
    rebalance: bool = True,
    observe: Observe = _unobserved,
) -> None:
    """Parquet by folder, sorted in each file.

    Rows are rebalanced on the folder columns: small folders share a task and one
    that holds much of the data is split over several, each writing its own file.
    Where each task has rows of few folders already, as when monthly files are read,
    that shuffle can be left out.
    By default folders present in ``df`` are replaced and others kept, so a run
    can be repeated; ``append`` adds files instead.  ``observe`` may look at the rows
    after the last shuffle, where a task that is run again counts once.
    """
    spread = observe(df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df)
    writer = spread.sortWithinPartitions(*by, *order).write.partitionBy(*by)
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder and what is in it, on whatever file system it is; nothing happens if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def write_clean_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and blanks kept as they are."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
