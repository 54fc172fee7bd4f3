"""Monthly admission extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landfall.schemas import EXTRACT
from landfall.sources.files import discover_inputs, order_months
from landfall.sources.footers import lacking

# Files named when columns are missing, and the pattern where none is given; Spark passes over hidden files.
NAMED = 5
DATA_FILES = "*"


def scan_admissions(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType = EXTRACT,
    file_format: str = "parquet",
    pattern: str | None = None,
) -> DataFrame:
    """All given extracts in one typed scan, of files whose names match ``pattern`` if one is given.

    A file that lacks a column of ``schema`` stops the job: read as nulls, it would be
    filled and pass all checks.  Of Parquet the footers of all files are looked at, in
    one job, before any row is read; every CSV file is checked as it is read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if file_format == "parquet":
        check_columns(spark, paths, schema, pattern)
    reader = _reader(spark, pattern).schema(schema)
    if file_format == "csv":
        # The header is checked against the schema rather than skipped.
        reader = reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.format(file_format).load(paths)


def _reader(spark: SparkSession, pattern: str | None):
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def check_columns(spark: SparkSession, paths: Sequence[str], schema: StructType, pattern: str | None = None) -> None:
    """Raises ``ValueError`` naming files without some of the columns, and these."""
    found = lacking(spark, list(paths), schema.names, pattern or DATA_FILES)
    named = found.orderBy("path").limit(NAMED + 1).collect()
    if named:
        rows = [f"{r['path']} lacks {', '.join(r['lacks'])}" for r in named[:NAMED]]
        raise ValueError("; ".join(rows) + ("; and others" if len(named) > NAMED else ""))


def scan_latest(
    spark: SparkSession,
    root: str,
    pattern: str = "*.parquet",
    schema: StructType = EXTRACT,
    file_format: str = "parquet",
) -> DataFrame:
    """Every month below ``root``, superseded deliveries left unread (``files.superseded`` tells which).

    The list brought to the driver has one entry an extract, not one a row.
    """
    months = order_months(discover_inputs(spark, root, pattern)).collect()
    if not months:
        raise FileNotFoundError(f"no extract named like {pattern} below {root}")
    return scan_admissions(spark, [p for m in months for p in m["paths"]], schema, file_format, pattern)
