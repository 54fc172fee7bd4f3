"""Finding extracts and telling their month from their name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The month marks in extract names.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
# Fixed value: an extract is named <anything>MMMYY_sub<anything>; it is one file, or a folder of parts.
_NAMED = r"^(.*([a-z]{3})(\d{2})_sub[^/]*)"
# Parts of one delivery lie in one folder and have one name up to a part mark.
_DELIVERY = r"^(.*[a-z]{3}\d{2}_sub[^/]*?)(?:[_-]?part[_-]?\d+)?(?:\.[^/]*)?(?:/.*)?$"


def extract_path(path: Column) -> Column:
    """The path up to and including the component that names the extract."""
    return F.regexp_extract(path, _NAMED, 1)


def delivery_path(path: Column) -> Column:
    """The extract's path without part mark and ending, the same for all parts of a delivery."""
    return F.regexp_extract(path, _DELIVERY, 1)


def month_mark(path: Column) -> Column:
    return F.regexp_extract(path, _NAMED, 2)


def year_mark(path: Column) -> Column:
    return F.regexp_extract(path, _NAMED, 3)


def month_number(path: Column) -> Column:
    """1 to 12; a name with an unknown month stops the job rather than losing the file."""
    pairs = [F.lit(part) for pair in MONTHS.items() for part in pair]
    known = F.element_at(F.create_map(*pairs), month_mark(path))
    return F.coalesce(known, F.raise_error(F.concat(F.lit("no month in file name: "), path)).cast("int"))


def year_number(path: Column) -> Column:
    """Four-digit year, two-digit years below 70 being after 2000."""
    short = year_mark(path).cast("int")
    return short + F.when(short < 70, 2000).otherwise(1900)


def discover_inputs(spark: SparkSession, root: str | Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """One row per matching file anywhere below ``root``, or several of them; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )


def with_file_month(files: DataFrame) -> DataFrame:
    """Adds the extract a file belongs to, its delivery, and its year and month."""
    path = F.col("path")
    return files.withColumns({
        "extract": extract_path(path),
        "delivery": delivery_path(path),
        "extract_year": year_number(path),
        "extract_month": month_number(path),
    })


def order_months(files: DataFrame) -> DataFrame:
    """One delivery a year and month, in calendar order; of several, the greatest path.

    ``paths`` has the extracts of the delivery, all its parts.  The sort is over months, not
    rows of data.  What is left out is told by ``superseded``.
    """
    return (
        with_file_month(files)
        .groupBy("extract_year", "extract_month", "delivery")
        .agg(F.sort_array(F.collect_set("extract")).alias("paths"))
        .groupBy("extract_year", "extract_month")
        .agg(F.max(F.struct("delivery", "paths")).alias("last"))
        .select("extract_year", "extract_month", F.col("last.delivery").alias("extract"), "last.paths")
        .orderBy("extract_year", "extract_month")
    )


def superseded(files: DataFrame) -> DataFrame:
    """The files of deliveries that a later one of the same month replaces."""
    kept = order_months(files).select(F.col("extract").alias("delivery"))
    return with_file_month(files).join(kept, "delivery", "left_anti").select(files.columns)
