"""The four code lists, read as text so that codes such as ``004`` and ``NA`` survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landfall.functions.keys import as_integer
from landfall.schemas import ISO, RAW_COUNTRIES, RAW_PORTS


def required(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` that stop the job where a key column is null."""
    kinds = dict(rows.dtypes)
    return rows.withColumns(
        {k: F.coalesce(F.col(k), F.raise_error(F.lit(f"{k} is null in a list")).cast(kinds[k])) for k in keys}
    )


def scan_list(spark: SparkSession, path: str, schema: StructType, *keys: str) -> DataFrame:
    """A list with a header line, its columns named by position; a malformed line or a null key stops the job."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return required(rows, *keys)


def scan_ports(spark: SparkSession, path: str) -> DataFrame:
    """Raw port list: quoted code, quoted ``NAME, STATE``."""
    return scan_list(spark, path, RAW_PORTS, "code")


def scan_countries(spark: SparkSession, path: str) -> DataFrame:
    """Raw country list: code, quoted name, ISO number."""
    return scan_list(spark, path, RAW_COUNTRIES, "code")


def scan_iso(spark: SparkSession, path: str) -> DataFrame:
    """ISO-3166 list: columns renamed by position, blanks null, code without leading zeros."""
    raw = scan_list(spark, path, ISO, "name", "country_code")
    blank_to_null = {c: F.when(F.col(c) != "", F.col(c)) for c in raw.columns}
    return raw.withColumns(blank_to_null).withColumn(
        "country_code", as_integer(F.col("country_code")).cast("string")
    )


def scan_iata(spark: SparkSession, path: str) -> DataFrame:
    """World airport list: names from the header line, every column text."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def apply_schema(df: DataFrame, schema: StructType, *keys: str) -> DataFrame:
    """Columns renamed and cast by position; the counts must agree, and a null key stops the job."""
    if len(df.columns) != len(schema):
        raise ValueError(f"{len(df.columns)} columns for a schema of {len(schema)}")
    typed = df.toDF(*schema.names).select(
        [F.col(field.name).cast(field.dataType).alias(field.name) for field in schema]
    )
    return required(typed, *keys)
