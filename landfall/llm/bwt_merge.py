"""Exact substring dedup over bytes: Burrows-Wheeler transforms of shards, merged by refining how they interleave."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import BYTE_VALUES, flat, slices
from landfall.llm.repeats import bounds_of, covered_ranges, mask_of, unpacked, with_ranges
from landfall.llm.tables import free_name

WINDOW = 200
GRAM = 100
SHARD_BYTES = 1 << 18
# A symbol of the transforms is so many bytes, of which the window is a multiple; the first of them are read at once.
STEP = 20
FIRST_BYTES = 5


def byte_symbols(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    return BYTE_VALUES[data], offsets


def _bytes_of(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def numbers_of(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each place the ``STEP`` bytes from there on as one symbol: equal for equal bytes, and in their order.

    ``cuts`` are the borders of shards; what is beyond the end of a shard is read from its start.
    """

    def further(values: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([np.roll(values[a:b], -by) for a, b in zip(cuts[:-1], cuts[1:])])

    def dense(values: np.ndarray) -> np.ndarray:
        return np.unique(values, return_inverse=True)[1]

    words = np.zeros(len(data), np.uint64)
    for k in range(FIRST_BYTES):
        words = words << np.uint64(8) | further(data, k)
    numbers, length = dense(words), FIRST_BYTES
    while length < STEP:
        numbers = dense(numbers * len(data) + further(numbers, length))
        length *= 2
    return numbers.astype(np.int32)


def by_symbol(symbols: np.ndarray) -> np.ndarray:
    """The order of symbols, equal ones as they come, from one counting sort for each half of their bits."""
    low = np.argsort(symbols.astype(np.uint16), kind="stable")
    if symbols.max(initial=0) < 1 << 16:
        return low
    return low[np.argsort((symbols >> 16).astype(np.uint16)[low], kind="stable")]


def _firsts(symbols: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Where a sorted row of pairs has a new one."""
    new = np.ones(len(symbols), bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (sets[1:] != sets[:-1])
    return new


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of a shard in order of their first ``depth`` bytes, and its Burrows-Wheeler transform: the symbol before each."""
    order = by_symbol(symbols)
    new = _firsts(symbols[order], np.zeros(len(order), np.int8))
    for _ in range(depth // STEP - 1):
        if new.all():
            break
        before = (order - STEP) % len(symbols)
        symbol, sets = symbols[before], np.cumsum(new)
        by = by_symbol(symbol)
        order, new = before[by], _firsts(symbol[by], sets[by])
    return order, symbols[(order - STEP) % len(symbols)]


def merged(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of shards in one order, from their transforms alone.

    To begin with, shards follow one another.  Reading the transforms as they interleave and sorting what is read
    by symbol, equal symbols as they come, gives the interleave for ``STEP`` bytes more: nothing is compared but
    symbols, and each shard keeps its order.  Two neighbours have a common prefix of all bytes so far if
    their symbols are equal and what follows these was in one set before.

    Returns elements, numbered through the shards, in that order, and where each set of equal ones begins.
    """
    sizes = [len(t) for t in transforms]
    symbols = np.concatenate(transforms)
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint8 if len(sizes) <= 256 else np.uint32), sizes)
    elements = np.arange(len(symbols), dtype=np.int32)
    new = elements == 0
    for _ in range(depth // STEP):
        symbol, sets = symbols[elements], np.cumsum(new, dtype=np.int32)
        by = by_symbol(symbol)
        interleave, new = interleave[by], _firsts(symbol[by], sets[by])
        elements[np.argsort(interleave, kind="stable")] = np.arange(len(symbols), dtype=np.int32)
        if new.all():
            break
    return elements, new


def _repeated(spans: list[bytes], counts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the spans that another window equals."""
    return repeated_windows(spans, WINDOW)


def repeated_windows(strings: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """String and place of all stretches of ``window`` bytes, a multiple of ``STEP``, that are there more than once.

    Shards are whole strings of about ``SHARD_BYTES`` together.
    """
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    starts = np.cumsum(sizes) - sizes
    cuts = np.append(starts[np.flatnonzero(np.diff(starts // SHARD_BYTES, prepend=-1))], len(data))
    symbols = numbers_of(data, cuts)
    orders, transforms = zip(*(transform(symbols[a:b], window) for a, b in zip(cuts[:-1], cuts[1:])))
    elements, new = merged(list(transforms), window)
    place = np.concatenate([a + order for a, order in zip(cuts, orders)])[elements]
    # What goes beyond the end of its string is no window, whatever it equals.
    whole = place + window < (starts + sizes)[np.searchsorted(starts, place, "right") - 1]
    sets = np.cumsum(new) - 1
    several = np.bincount(sets[whole], minlength=sets[-1] + 1)[sets] > 1
    at = np.sort(place[whole & several])
    row = np.searchsorted(starts, at, "right") - 1
    return row, at - starts[row]


def _byte_ranges(docs: DataFrame) -> DataFrame:
    return covered_ranges(docs, byte_symbols, _bytes_of, _repeated, WINDOW, GRAM, earlier_only=False)


def _cut(text: bytes, ranges_: list[dict] | None) -> tuple[bytes, int]:
    """The bytes that remain, and how many runs were taken out."""
    if not ranges_:
        return text, 0
    removed = mask_of(len(text), *bounds_of(ranges_))
    runs = int(removed[0]) + int((removed[1:] & ~removed[:-1]).sum())
    return np.frombuffer(text, np.uint8)[~removed].tobytes(), runs


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the other bytes) and ``kept_sha256`` of every document.

    A byte goes if it is covered by 200 bytes that start anywhere else, too.  Null texts are empty.
    Documents with a null doc_id lose nothing and others lose nothing for them.  Repeated rows
    give repeated rows and repeat each other; rows that share a doc_id are cut alike.
    Other columns do not matter.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            out = []
            for text, ranges_ in zip(unpacked(batch.column("packed")).to_pylist(), batch.column("ranges").to_pylist()):
                kept, runs = _cut(text, ranges_)
                out.append((len(text), len(text) - len(kept), runs, kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    return with_ranges(rows, _byte_ranges(rows)).mapInArrow(run, kinds)


def repeat_digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).drop("kept")


def cut_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with what repeats cut out of ``text``; letters cut in two go whole, ``n_chars``, if there, is counted anew.

    A document may end up empty, and stays.  Rows are kept, as are all other columns.
    """
    rows = docs.withColumn("text", F.col("text").cast("string"))
    name, key = free_name(docs, "ranges"), free_name(docs, "ranges_of")
    of = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _byte_ranges(of).select(F.col("doc_id").alias(key), F.col("ranges").alias(name))
    joined = rows.join(found, F.col("doc_id") == F.col(key), "left").drop(key)

    def cut(text: pa.Array, found: pa.Array) -> pa.Array:
        pairs = zip(text.to_pylist(), found.to_pylist())
        return pa.array([_cut(t.encode(), r)[0].decode("utf-8", "ignore") if r else t for t, r in pairs], pa.string())

    rows = joined.withColumn("text", F.arrow_udf(cut, "string")(F.col("text"), F.col(name))).drop(name)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
