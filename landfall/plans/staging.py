"""Sources to cleaned frames, and the staging tables on disk."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landfall.operators.clean import clean_countries, clean_ports, fill_nulls
from landfall.schemas import EXTRACT
from landfall.sinks.writers import write_overwrite
from landfall.sources.extracts import scan_latest
from landfall.sources.lookups import scan_countries, scan_iata, scan_iso, scan_ports
from landfall.sources.tables import scan_parquet


@dataclass(frozen=True)
class Staged:
    """The four inputs of every table build, and the world airport list if it is wanted."""

    extract: DataFrame
    ports: DataFrame
    countries: DataFrame
    iso: DataFrame
    iata: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: df for f in fields(self) if (df := getattr(self, f.name)) is not None}


def stage(
    spark: SparkSession,
    extracts: str,
    ports: str,
    countries: str,
    iso: str,
    schema: StructType = EXTRACT,
    pattern: str = "*.parquet",
    file_format: str = "parquet",
    iata: str | None = None,
) -> Staged:
    """The sources, code lists cleaned, nothing written."""
    return Staged(
        extract=scan_latest(spark, extracts, pattern, schema, file_format),
        ports=clean_ports(scan_ports(spark, ports)),
        countries=clean_countries(scan_countries(spark, countries)),
        iso=scan_iso(spark, iso),
        iata=scan_iata(spark, iata) if iata else None,
    )


def stage_tables(spark: SparkSession, staged: Staged, base: str) -> Staged:
    """Written to Parquet and read back, so that later steps start from files."""
    paths = {name: f"{base}/{name}_staging" for name in staged.tables()}
    for name, df in staged.tables().items():
        write_overwrite(df, paths[name])
    return Staged(**{name: scan_parquet(spark, path) for name, path in paths.items()})


def clean_admissions_extract(staged: Staged) -> DataFrame:
    return fill_nulls(staged.extract)
