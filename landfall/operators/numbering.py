"""Dense numbers for keys, the same on every run, without bringing keys to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import workspace
from landfall.sinks.snapshots import Layout, Update, read_snapshot

NUMBERS = Layout(("batch",))
# Fixed value: the bits of Spark's increasing ids that count rows within a partition.
ROW_BITS = 33


def offsets(counts: DataFrame) -> DataFrame:
    """``part`` and ``offset``, the rows of all parts before it, from ``part`` and ``n``: one array with an entry a part."""
    sizes = counts.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("sizes"))

    def before(entry, place):
        rows = F.aggregate(F.slice("sizes", F.lit(1), place), F.lit(0).cast("bigint"), lambda total, e: total + e["n"])
        return F.struct(entry["part"].alias("part"), rows.alias("offset"))

    return sizes.select(F.inline(F.transform("sizes", before)))


def in_ranges(distinct: DataFrame) -> DataFrame:
    """Distinct rows sorted in ranges and written, each with an ``_id`` of its range and its place there."""
    spark, names, path = distinct.sparkSession, distinct.columns, workspace(distinct.sparkSession)
    placed = distinct.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("_id", F.monotonically_increasing_id())
    # Written once: ranges come from a sample and would not be the same twice.
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def counted_on(placed: DataFrame, start: int) -> DataFrame:
    """Rows of ``in_ranges`` with a ``number`` in place of their id: a range goes on where the one before it ends."""
    rows = placed.withColumn("part", F.shiftright("_id", ROW_BITS))
    first = offsets(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    place = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    names = [c for c in placed.columns if c != "_id"]
    # A row a range: Spark can't tell that this side is short.
    return rows.join(F.broadcast(first), "part").select(*names, (F.col("offset") + place + F.lit(start)).alias("number"))


def dense_numbers(keys: DataFrame, start: int = 0) -> DataFrame:
    """Each distinct row of ``keys`` with a ``number``, from ``start`` on in the order of the rows.

    Rows are sorted in ranges; a range is numbered apart and then moved on by the rows of the ranges
    before it.  The number depends on the keys alone, not on how they were dealt.
    """
    return counted_on(in_ranges(keys.distinct()), start)


def unknown(keys: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct rows of ``keys`` that ``known`` lacks, nulls being equal; both are shuffled once."""
    names = keys.columns
    marked = keys.withColumn("_known", F.lit(False)).unionByName(known.select(*names, F.lit(True).alias("_known")))
    return marked.groupBy(*names).agg(F.bool_or("_known").alias("_known")).where(~F.col("_known")).select(*names)


def numbered(spark: SparkSession, base: str, name: str, keys: DataFrame) -> DataFrame:
    """The key map ``name`` below ``base`` with the new keys of ``keys`` added; numbers given before stay.

    The map is a snapshot: a run that fails has given no number.  A run over known keys adds nothing.
    Keys are computed once: whether any are new is asked of what was sorted and written.
    """
    update = Update(spark, base)
    known, start = update.read_former(name), 0
    if known is None:
        placed = in_ranges(keys.distinct())
    else:
        known = known.drop("batch")
        start = known.agg(F.max("number")).first()[0] + 1
        placed = in_ranges(unknown(keys, known))
        if placed.isEmpty():
            return known
    batch = len({part for table, part in update.entries if table == name}) + 1
    # The files of ranges are few and of one batch, so they need no other shuffle.
    update.write(name, counted_on(placed, start).withColumn("batch", F.lit(batch)), NUMBERS, [], rebalance=False)
    update.publish()
    return read_snapshot(spark, base, name).drop("batch")
