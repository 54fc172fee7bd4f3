"""Rows that share a bucket, brought together in groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one block; a group has at most two blocks.
BLOCK_ROWS = 1000


def shared_buckets(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows whose ``bucket`` holds several, dealt to pairs of blocks (``one``, ``other``).

    A bucket of more than ``block_rows`` is cut into blocks by ``id``, and each of its
    rows goes to all pairs of blocks that have its own, so any two rows of a bucket
    meet, no task holds more than two blocks, and a hot bucket is spread.  Two rows of
    one block meet in several groups; the one to count is that with ``one = other``.
    """
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    blocks = F.ceil(F.col("_rows") / block_rows)
    return (
        rows.join(counts, "bucket")
        .withColumn("_own", F.pmod(F.xxhash64("id"), blocks))
        .withColumn("_with", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .withColumn("one", F.least("_own", "_with"))
        .withColumn("other", F.greatest("_own", "_with"))
        .drop("_rows", "_with")
        .withColumnRenamed("_own", "own")
    )


def together(dealt: DataFrame) -> DataFrame:
    keys = ["bucket", "one", "other"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "id")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables that cut no group in two, with the starts of the groups and the end."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = group_starts(batch, keys)
        if rest:
            same = all(rest[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
            if same and len(changes) == 1:
                rest.append(batch)
                continue
            head = int(changes[1]) if same else 0
            table = pa.Table.from_batches([*rest, batch.slice(0, head)]).combine_chunks()
            yield table, np.append(group_starts(table, keys), table.num_rows)
            batch = batch.slice(head)
            changes = group_starts(batch, keys)
        last = int(changes[-1])
        if last:
            table = pa.Table.from_batches([batch.slice(0, last)])
            yield table, np.append(changes[:-1], last)
        rest = [batch.slice(last)]
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, np.append(group_starts(table, keys), table.num_rows)


def group_starts(rows, keys: list[str]) -> np.ndarray:
    changed = np.zeros(rows.num_rows, bool)
    changed[0] = True
    for key in keys:
        values = rows.column(key).to_numpy() if isinstance(rows, pa.Table) else rows.column(key).to_numpy(zero_copy_only=False)
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)
