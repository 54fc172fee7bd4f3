"""What the footers of Parquet files say of their columns: a row a file, and no row of data read."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sources.files import discover_inputs

COLUMNS = "path string, length bigint, columns array<string>"


def footers(files: DataFrame) -> DataFrame:
    """``path``, ``length`` and ``columns`` of every file of a listing.

    Tasks open the files themselves and read their last few kilobytes.  ``columns`` is null where that
    cannot be done, because only Spark knows the store; ``lacking`` asks Spark for those.
    """

    # Within this function, so that executors need not have the package.
    def columns_of(path: str) -> list[str] | None:
        from pyarrow import ArrowException, fs
        from pyarrow.parquet import read_schema

        try:
            store, place = fs.FileSystem.from_uri(path)
            source = store.open_input_file(place)
        except (ArrowException, OSError, ValueError):
            return None
        with source:
            return read_schema(source).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            names = pa.array([columns_of(path) for path in paths], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), batch.column("length"), names], ["path", "length", "columns"])

    path = F.regexp_replace("path", "^file:/+", "file:///").alias("path")
    return files.select(path, F.col("length").cast("bigint").alias("length")).repartition("path").mapInArrow(run, COLUMNS)


def lacking(spark: SparkSession, paths: str | Sequence[str], required: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """``path`` and ``lacks`` of the files below ``paths`` without some of the ``required`` columns; names as Spark compares them.

    The files that tasks could not open are read by Spark, one schema at a time; only their names come to the driver.
    """
    found = footers(discover_inputs(spark, paths, pattern))
    known = found.where("columns is not null").select("path", "columns")
    closed = [r["path"] for r in found.where("columns is null").select("path").collect()]
    if closed:
        with ThreadPoolExecutor(16) as pool:
            names = pool.map(lambda path: spark.read.parquet(path).columns, closed)
            known = known.unionByName(spark.createDataFrame(list(zip(closed, names)), "path string, columns array<string>"))
    folded = spark.conf.get("spark.sql.caseSensitive") != "true"
    own = F.transform("columns", F.lower) if folded else F.col("columns")
    wanted = F.array(*[F.lit(name) for name in required])
    lacks = F.filter(wanted, lambda name: ~F.array_contains(own, F.lower(name) if folded else name))
    return known.select("path", lacks.alias("lacks")).where(F.size("lacks") > 0)
