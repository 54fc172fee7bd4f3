"""Join keys and row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_number(value: Column) -> Column:
    """A code as a number whether it is stored as number or text; null if it is neither."""
    return value.try_cast("double")


def as_integer(value: Column) -> Column:
    """A zero-padded code as an integer, so ``004`` equals ``4``; null if not a number."""
    return value.try_cast("int")


def same_number(left: Column, right: Column) -> Column:
    """Number against text, compared as numbers."""
    return as_number(left) == as_number(right)


def natural_id(df: DataFrame) -> Column:
    """Year, month and record number of the extract row: the same on every run.

    Null if any of them is, so that the key check finds the row.
    """
    record = df["cicid"]
    if df.schema["cicid"].dataType.typeName() == "double":
        record = record.cast("bigint")
    year, month = df["i94yr"].cast("int").cast("string"), df["i94mon"].cast("int").cast("string")
    return F.concat(year, F.lit("-"), month, F.lit("-"), record.cast("string"))


def run_id() -> Column:
    """A 64-bit id unique within one run; it differs from run to run."""
    return F.monotonically_increasing_id()
