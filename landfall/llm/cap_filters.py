"""Near-duplicate vectors by spherical-cap filters with structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.buckets import shared_buckets, together, whole_groups
from landfall.llm.components import components
from landfall.llm.tables import stored

COSINE = 0.9
# Directions are all pairs of CODE vectors for the two halves of a turned vector, for each turn.
TURNS = 8
CODE = 120
# A unit vector is in the cap of a direction if their product, over its standard deviation, is so large.
# Of the 115,200 caps 83 hold a vector in the mean.  Measured in 64 dimensions, of 20,000 pairs with a cosine
# of 0.90 one shared no cap, and none of as many with 0.95.  For a multiple of the vectors raise CAP, and CODE
# with it: a cap then holds as few of them as before.
CAP = 3.2
SEED = 20
BUCKETS_OF_A_SIZE = 1 << 40


@lru_cache(maxsize=8)
def product_code(size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A turn and two half codes, for each turn, for vectors of that size; the same in every task."""
    random = np.random.default_rng([SEED, size])
    half, codes = size // 2, []
    for _ in range(TURNS):
        turn = np.linalg.qr(random.standard_normal((size, size)))[0]
        codes.append((turn, random.standard_normal((CODE, half)), random.standard_normal((CODE, size - half))))
    return codes


def caps(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All caps that hold each of the unit vectors, as pairs of row and cap number.

    A list decoding: only words of the first half that reach the limit together with the
    best of the second are paired with words of the second.
    """
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    half = unit.shape[1] // 2
    for number, (turn, one, other) in enumerate(product_code(unit.shape[1])):
        turned = unit @ turn
        first, second = turned[:, :half] @ one.T, turned[:, half:] @ other.T
        row, word = np.nonzero(first >= CAP - second.max(axis=1)[:, None])
        pair, partner = np.nonzero(second[row] >= (CAP - first[row, word])[:, None])
        rows.append(row[pair])
        found.append((number * CODE + word[pair]) * CODE + partner)
    return np.concatenate(rows), np.concatenate(found)


def _by_size(batch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of a batch, for each size of vectors in it."""
    column = batch.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        vectors = values[starts[rows][:, None] + np.arange(size)].astype(np.float64)
        yield rows, vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _into_caps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy()
        for rows, unit in _by_size(batch):
            for k in range(0, len(unit), 512):
                which, number = caps(unit[k : k + 512])
                bucket = number + unit.shape[1] * BUCKETS_OF_A_SIZE
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows[k + which]]), pa.array(bucket)], ["id", "bucket"])


def _met_first_here(unit: np.ndarray, linked: np.ndarray, cap: int) -> np.ndarray:
    """Of the linked pairs those that share no cap of a smaller number, so that each pair counts once."""
    which, number = caps(unit)
    which, number = which[number < cap], number[number < cap]
    values, column, counts = np.unique(number, return_inverse=True, return_counts=True)
    several = counts[column] > 1
    if not several.any():
        return linked
    column = np.unique(column[several], return_inverse=True)[1]
    member = np.zeros((len(unit), int(column.max()) + 1), np.float32)
    member[which[several], column] = 1
    return linked & (member @ member.T == 0)


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected to."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(root)).min(axis=1)
        least = np.minimum(root, least)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in whole_groups(batches, ["bucket", "one", "other"]):
        ids, copies, own = (table.column(c).to_numpy() for c in ("id", "copies", "own"))
        buckets, same_block = table.column("bucket").to_numpy(), (table.column("one").to_numpy() == table.column("other").to_numpy())
        unit_of = np.empty(table.num_rows, object)
        for rows, unit in _by_size(table):
            for row, vector in zip(rows, unit):
                unit_of[row] = vector
        a, b, n = [], [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            unit = np.stack(unit_of[s:e])
            linked = unit @ unit.T >= COSINE
            np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            some = np.flatnonzero(linked.any(axis=1))
            linked, unit, at = linked[np.ix_(some, some)], unit[some], s + some
            root = _roots(linked)
            a += [ids[at], ids[at]]
            b += [ids[at[root]], np.full(len(at), -1)]
            apart = own[at][:, None] != own[at][None, :]
            counted = _met_first_here(unit, linked & (apart | same_block[s]), int(buckets[s] % BUCKETS_OF_A_SIZE))
            n += [np.full(len(at), -1), counted @ copies[at]]
        if a:
            a, b, n = (np.concatenate(x).astype(np.int64) for x in (a, b, n))
            edge = n < 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b, mask=~edge), pa.array(n, mask=edge)], ["a", "b", "n"]
            )


def usable(vector: Column) -> Column:
    """Vectors with a direction: no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Every vector with the number of vectors it is linked to and the class it is in.

    ``vectors`` has ``vec_id`` and ``embedding``.  Two are linked if both are usable, of one
    size, and their cosine is at least 0.9.  Returns ``vec_id``, ``n_links``, ``component_id`` (the
    smallest vec_id reachable, itself included) and ``kept``, one row for each vec_id: of rows
    that repeat one the smallest embedding counts.  Equal vectors are compared once
    and counted as often as they occur.  Vectors that are null, zero, or hold a null or
    non-finite component are linked with nothing; a null vec_id is in no class and kept.
    """
    # Floats are shuffled as they are, at half the size, and read in double precision.
    floats = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), True)
    vector = F.col("embedding") if floats else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    sound = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    distinct = stored(rows.where(sound).groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    held = distinct.select("id", "vector").mapInArrow(_into_caps, "id bigint, bucket bigint")
    dealt = shared_buckets(held).join(distinct, "id")
    dealt = dealt.select("bucket", "one", "other", "own", "id", "copies", "vector")
    found = stored(together(dealt).mapInArrow(_verified, "a bigint, b bigint, n bigint"))
    classes = components(found.where("b is not null").select("a", "b"))
    counts = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    distinct = (
        distinct.join(counts, "id", "left")
        .join(classes, distinct["id"] == classes["node"], "left")
        .select(
            F.col("vector").alias("_vector"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("component", "id").alias("_class"),
        )
    )
    return rows.join(distinct, sound & (F.col("vector") == F.col("_vector")), "left").select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("_class", "vec_id").alias("component_id"),
        F.coalesce(F.col("_class") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
