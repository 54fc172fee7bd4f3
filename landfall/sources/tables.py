"""Tables written earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_month(
    spark: SparkSession,
    path: str,
    year: int,
    month: int,
    by: tuple[str, str] = ("arrival_year", "arrival_month"),
) -> DataFrame:
    """One month of a table laid out by year and month; other folders are not opened."""
    return of_month(scan_parquet(spark, path), year, month, by)


def of_month(table: DataFrame, year: int, month: int, by: tuple[str, str] = ("arrival_year", "arrival_month")) -> DataFrame:
    return table.where((F.col(by[0]) == year) & (F.col(by[1]) == month))
