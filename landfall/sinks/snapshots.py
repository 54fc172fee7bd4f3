"""Sets of tables that change as one: new versions beside the old, and a small manifest written last.

A base folder holds ``<table>/version=<id>/...`` and ``manifests/<number>``.  A manifest has one row for each
part of each table, a part being a whole table or what one value of its part columns has, with the folder it
lies in.  Readers go through the newest manifest, so until a new one is complete they read the former
rows, whatever a failing write has left.  One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sinks.writers import folder_exists, remove_folder, write_partitioned
from landfall.sources.files import discover_inputs

MANIFESTS = "manifests"
ENTRY = "table_name string, part string, folder string"
WHOLE = ""


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk: ``parts`` can be replaced one by one; ``by`` are folders below a part."""

    parts: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def part(self, *values: object) -> str:
        return "/".join(f"{name}={value}" for name, value in zip(self.parts, values, strict=True))


def manifests(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the complete manifests, oldest first; a manifest is one file, so it is there as a whole or not at all."""
    if not folder_exists(spark, f"{base}/{MANIFESTS}"):
        return []
    files = discover_inputs(spark, f"{base}/{MANIFESTS}", "*.json")
    number = F.regexp_extract("path", f"/{MANIFESTS}/([0-9]+)/", 1).cast("int")
    return sorted(r["number"] for r in files.select(number.alias("number")).distinct().collect())


def current(spark: SparkSession, base: str, number: int | None = None) -> dict[tuple[str, str], str]:
    """Folders by table and part, of the newest manifest or that of a number; none before the first."""
    known = manifests(spark, base)
    if not known:
        return {}
    rows = spark.read.schema(ENTRY).json(f"{base}/{MANIFESTS}/{number or known[-1]}")
    return {(r["table_name"], r["part"]): r["folder"] for r in rows.collect() if r["table_name"]}


class Update:
    """A change of some tables: parts are written one table after the other, then published together.

    What an update has written and not published is never read.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.version = spark, base, uuid.uuid4().hex
        self.former = current(spark, base)
        self.entries = dict(self.former)

    def read_former(self, table: str, parts: Iterable[str] | None = None) -> DataFrame | None:
        """What readers see of a table, or of some of its parts, until this is published."""
        return _read(self.spark, self.base, table, parts, self.former)

    def write(
        self,
        table: str,
        df: DataFrame,
        layout: Layout = Layout(),
        replaced: Iterable[str] | None = None,
        rebalance: bool = True,
    ) -> DataFrame:
        """Writes rows beside the versions there are, and returns them as written.

        The parts named in ``replaced`` go, whether they have new rows or not; without it all parts of the table go.
        Rows whose tasks each have few parts may be spared the shuffle by ``rebalance``, as in ``write_partitioned``.
        """
        folder = f"{table}/version={self.version}"
        path = f"{self.base}/{folder}"
        columns = [*layout.parts, *layout.by]
        if columns:
            write_partitioned(df, path, columns, layout.order, append=True, rebalance=rebalance)
        else:
            df.write.parquet(path)
        self.drop(table, replaced)
        for part in self._parts(path, layout):
            self.entries[table, part] = f"{folder}/{part}".rstrip("/")
        return self.spark.read.schema(df.schema).parquet(path)

    def _parts(self, path: str, layout: Layout) -> list[str]:
        if not layout.parts:
            return [WHOLE]
        pattern = f"/version={self.version}/(" + "/".join(f"{name}=[^/]+" for name in layout.parts) + ")/"
        files = discover_inputs(self.spark, path)
        return [r["part"] for r in files.select(F.regexp_extract("path", pattern, 1).alias("part")).distinct().collect()]

    def drop(self, table: str, parts: Iterable[str] | None = None) -> None:
        """The parts named, or all parts of the table, will not be there."""
        gone = None if parts is None else set(parts)
        self.entries = {key: f for key, f in self.entries.items() if key[0] != table or (gone is not None and key[1] not in gone)}

    def publish(self) -> int:
        """Makes the update what readers see, all of it at once; returns the number of its manifest."""
        number = max(manifests(self.spark, self.base), default=0) + 1
        # The first row stands for no table, so that a manifest without tables is a file, too.
        rows = [("", "", ""), *((table, part, folder) for (table, part), folder in sorted(self.entries.items()))]
        path = f"{self.base}/{MANIFESTS}/{number}"
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").json(path)
        return number


def read_snapshot(
    spark: SparkSession, base: str, table: str, parts: Iterable[str] | None = None, number: int | None = None
) -> DataFrame | None:
    """The rows of a table, or of some of its parts, in the newest snapshot or that of a number; None if there are none.

    Folder columns are back in place; files of parts not asked for are not listed.
    """
    return _read(spark, base, table, parts, current(spark, base, number))


def _read(
    spark: SparkSession, base: str, table: str, parts: Iterable[str] | None, entries: dict[tuple[str, str], str]
) -> DataFrame | None:
    wanted = None if parts is None else set(parts)
    folders = [folder for (name, part), folder in entries.items() if name == table and (wanted is None or part in wanted)]
    if not folders:
        return None
    reader = spark.read.option("basePath", f"{base}/{table}")
    return reader.parquet(*[f"{base}/{folder}" for folder in folders]).drop("version")


def forget(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Deletes the manifests but the newest ``keep``, and the versions that none of these needs."""
    known = manifests(spark, base)
    old, stay = known[:-keep], known[-keep:]

    def versions(numbers: list[int]) -> set[str]:
        return {"/".join(f.split("/")[:2]) for number in numbers for f in current(spark, base, number).values()}

    needed = versions(stay)
    for folder in sorted(versions(old) - needed):
        remove_folder(spark, f"{base}/{folder}")
    for number in old:
        remove_folder(spark, f"{base}/{MANIFESTS}/{number}")
