"""Tables written between steps, and the split of documents into learned and held-out rows."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import workspace

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the executors, once for each application, so that their Python finds it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="landfall-"), f"{PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder and read again: computed once, and safe if an executor is lost."""
    spark = rows.sparkSession
    path = workspace(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a null id counts as not held out, though nothing is learned from it either."""
    return F.coalesce(remainder(doc_id) == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) != 0, F.lit(False))


def share_of_hash(column: Column, seed: int = 7) -> Column:
    """A number in [0, 1) that depends on the value alone, for samples that do not change between runs."""
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1 << 30)) / float(1 << 30)


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``rows`` has."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
