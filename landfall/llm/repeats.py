"""Repeated stretches of a fixed length across documents: which parts of a corpus can hold any, and what they are.

A window is so many consecutive symbols (words or bytes) of one document.  Each window is
owned by the gram inside it with the smallest hash; equal windows have equal owners at
the same distance.  Windows next to each other mostly share their owner, so a document
is a sequence of spans, each with one gram and all windows it owns.  Only spans whose gram
occurs elsewhere can hold a repeated window.  Spans that are equal as a whole are
settled at once, from their hashes.  What is left, spans with a gram in common that
differ somewhere, is fetched from the texts and compared window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.arrays import U64, Rolling, give_back, mixed, ranges, slices
from landfall.llm.buckets import whole_groups
from landfall.llm.tables import stored

# A text is taken in pieces of so many symbols, overlapping by a window.
PIECE = 1 << 22
# Grams with more spans than this are compared by window hashes, counted before they are shuffled.
CLASS_SPANS = 20_000
# Symbols of several classes that are compared at once; a larger class is compared alone.
RESOLVED_BYTES = 1 << 20
# Spans that a task compares among themselves before it hands them on.
HELD_SPANS = 1 << 18


def spans(values: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Spans of texts that lie in a row: hash of the gram, hash of the span, text, place of the first window, windows.

    ``values`` are 64-bit symbols, ``offsets`` where each text starts, with the end.
    """
    parts = []
    for first in range(0, max(1, len(values)), PIECE):
        last = min(len(values), first + PIECE + window - 1)
        parts.append(_spans(values[first:last], first, offsets, window, gram))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _spans(values, shift, offsets, window, gram):
    counts = np.clip(offsets[1:] - window + 1, shift, shift + PIECE) - np.clip(offsets[:-1], shift, shift + PIECE)
    starts = ranges(np.clip(offsets[:-1], shift, shift + PIECE) - shift, np.maximum(counts, 0))
    if not len(starts):
        return (np.zeros(0, U64), np.zeros(0, U64), *(np.zeros(0, np.int64) for _ in range(3)))
    rolling = Rolling(values)
    grams = rolling.every(gram)
    least = (grams & ~U64(0xFFFFFFFF)) | np.arange(len(grams), dtype=U64)
    width, reach = window - gram + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    owner = (least[starts] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(starts)))
    first, own = starts[at], owner[at]
    whole = rolling.of(first, first + n - 1 + window) ^ mixed((own - first).astype(U64) * U64(1 << 20) + n.astype(U64))
    text = np.searchsorted(offsets, first + shift, "right") - 1
    return grams[own], whole, text, first + shift - offsets[text], n


Symbols = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def span_rows(docs: DataFrame, symbols: Symbols, window: int, gram: int, earlier_only: bool) -> DataFrame:
    """Spans of all documents, those that are equal within a task's reach settled before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text"):
            values, offsets = symbols(batch.column("text"))
            a, c, text, first, n = spans(values, offsets, window, gram)
            held.append((a, c, batch.column("doc_id").to_numpy()[text], first, n))
            size += len(a)
            if size >= HELD_SPANS:
                yield _settled(held, earlier_only)
                held, size = [], 0
        if size:
            yield _settled(held, earlier_only)

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return rows.mapInArrow(run, "gram bigint, span bigint, doc_id bigint, first int, n int, copies int, settled boolean")


def _settled(held: list[tuple], earlier_only: bool) -> pa.RecordBatch:
    """One row for each distinct span, with its number of copies, and rows of what is sure to be covered.

    The row is the first copy.  With ``earlier_only`` the copies in later documents are covered; those in
    the same document are left out, as whatever holds for the first holds for them.
    Otherwise all are covered if there are several.  Covered spans that follow each other
    become one row, under a gram that no other row has.
    """
    a, c, ids, first, n = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((first, ids, c, a))
    a, c, ids, first, n = a[order], c[order], ids[order], first[order], n[order]
    lead = np.ones(len(a), bool)
    lead[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    number = np.cumsum(lead) - 1
    copies = np.bincount(number)
    at = np.flatnonzero(lead)
    sure = ids > ids[at][number] if earlier_only else copies[number] > 1
    d, f, w = ids[sure], first[sure], n[sure]
    order = np.lexsort((f, d))
    d, f, w = d[order], f[order], w[order]
    new = np.ones(len(d), bool)
    # Spans share no window, so the last of one and the first of the next are neighbours or apart.
    new[1:] = (d[1:] != d[:-1]) | (f[1:] > f[:-1] + w[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(d))[: len(begin)] - 1
    run_first, run_n = f[begin], f[end] + w[end] - f[begin]
    own = mixed(d[begin].astype(U64) * U64(0x9E3779B97F4A7C15) + run_first.astype(U64))
    columns = [
        np.append(a[at], own).view(np.int64),
        np.append(c[at], own).view(np.int64),
        np.append(ids[at], d[begin]),
        np.append(first[at], run_first).astype(np.int32),
        np.append(n[at], run_n).astype(np.int32),
        np.append(copies, np.ones(len(begin), np.int64)).astype(np.int32),
        np.append(np.zeros(len(at), bool), np.ones(len(begin), bool)),
    ]
    names = ["gram", "span", "doc_id", "first", "n", "copies", "settled"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def classified(rows: DataFrame) -> DataFrame:
    """Spans whose gram occurs again, with what is known of the spans equal to them and of their class.

    One shuffle by gram serves all: how many are ``equal`` and their smallest document, whether
    the class has spans that ``differ``, and whether it is ``large``.  Rows ``settled`` before stay.
    """
    same = Window.partitionBy("gram", "span")
    by_gram = Window.partitionBy("gram")
    return (
        rows.withColumn("equal", F.sum("copies").over(same))
        .withColumn("smallest", F.min("doc_id").over(same))
        .withColumn("nth", F.row_number().over(same.orderBy("doc_id", "first")))
        .withColumn("spans", F.count(F.lit(1)).over(by_gram))
        .withColumn("differ", F.min("span").over(by_gram) != F.max("span").over(by_gram))
        .where("spans > 1 or copies > 1 or settled")
        .withColumn("large", F.col("spans") > CLASS_SPANS)
        .drop("spans", "copies")
    )


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the compressed text, to be shuffled; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            small = pa.array([pack.compress(t or b"") for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), small], ["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, packed binary")


def unpacked(column) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(x) for x in column.to_pylist()], pa.binary())


# From the symbols of spans, how many windows each owns, and its document: spans and places of repeated windows.
Resolve = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _fetched(wanted: DataFrame, docs: DataFrame, take: Callable[[bytes], np.ndarray], window: int) -> DataFrame:
    """The symbols of wanted spans; for those of large classes, each window by two hashes instead.

    ``take`` gives the 64-bit symbols of a text, one byte each or eight.
    """
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "first", "n", "large")).alias("wanted"))
    joined = packed(docs.where("doc_id is not null and text is not null")).join(lists, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            out: list[tuple] = []
            for doc_id, text, own in zip(
                batch.column("doc_id").to_pylist(), unpacked(batch.column("packed")).to_pylist(), batch.column("wanted")
            ):
                symbols, rolling = take(text), None
                for span in own.as_py():
                    first, n = span["first"], span["n"]
                    part = symbols[first : first + n + window - 1]
                    if len(part) < n + window - 1:
                        continue
                    if not span["large"]:
                        out.append((span["gram"], 0, doc_id, first, n, part.tobytes(), False))
                        continue
                    rolling = rolling or Rolling(mixed(symbols.astype(U64) + U64(0x51)))
                    again = Rolling(mixed(part.astype(U64) + U64(0xA7)))
                    at = np.arange(n)
                    one = rolling.of(first + at, first + at + window).view(np.int64)
                    other = again.of(at, at + window).view(np.int64)
                    out += [(h, g, doc_id, first + k, 1, None, True) for k, (h, g) in enumerate(zip(one.tolist(), other.tolist()))]
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
            names = ["gram", "other", "doc_id", "first", "n", "symbols", "large"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    kinds = "gram bigint, other bigint, doc_id bigint, first int, n int, symbols binary, large boolean"
    return joined.mapInArrow(run, kinds)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole classes, in sorted batches, with about ``RESOLVED_BYTES`` of symbols together."""
    for table, starts in whole_groups(batches, ["gram"]):
        sizes = pc.binary_length(table.column("symbols")).to_numpy()
        done = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[starts]
        first = 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(done, done[first] + RESOLVED_BYTES, "right")) - 1)
            yield table.slice(starts[first], starts[last] - starts[first])
            first = last


def _resolved(fetched: DataFrame, resolve: Resolve, window: int) -> DataFrame:
    """Ranges covered by repeated windows of classes of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _portions(batches):
            docs, firsts, counts = (table.column(c).to_numpy() for c in ("doc_id", "first", "n"))
            row, at = resolve(table.column("symbols").to_pylist(), counts, docs)
            if not len(row):
                continue
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row)) - 1
            start = firsts[row[begin]] + at[begin]
            stop = firsts[row[begin]] + at[end] + window
            arrays = [docs[row[begin]], start.astype(np.int32), stop.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["doc_id", "start", "stop"])
        give_back()

    cold = fetched.where("not large").select("gram", "doc_id", "first", "n", "symbols")
    return cold.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "doc_id bigint, start int, stop int")


def _counted(fetched: DataFrame, earlier_only: bool, window: int) -> DataFrame:
    """Ranges covered by repeated windows of large classes, from counts made in each task before the shuffle."""
    hot = fetched.where("large").select("gram", "other", "doc_id", "first")
    keys = ["gram", "other"]
    counts = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("spans"), F.min("doc_id").alias("smallest"))
    covered = hot.join(counts.where("spans > 1"), keys)
    if earlier_only:
        covered = covered.where("doc_id > smallest")
    return covered.select("doc_id", F.col("first").alias("start"), (F.col("first") + window).alias("stop"))


def covered_ranges(
    docs: DataFrame,
    symbols: Symbols,
    take: Callable[[bytes], np.ndarray],
    resolve: Resolve,
    window: int,
    gram: int,
    earlier_only: bool,
) -> DataFrame:
    """``doc_id`` and ``ranges`` (start, stop) of symbols covered by windows that occur elsewhere.

    With ``earlier_only`` just those that also start in a document of smaller doc_id; every window within
    a range is one, but where a document has a window several times, maybe only one
    of them is in a range.  Ranges may overlap.  Documents with a null id or text take no part.
    """
    rows = stored(classified(span_rows(docs, symbols, window, gram, earlier_only)))
    if earlier_only:
        equal, wanted = F.col("doc_id") > F.col("smallest"), F.col("doc_id") == F.col("smallest")
    else:
        equal, wanted = F.col("equal") > 1, F.col("nth") == 1
    stop = F.col("first") + F.col("n") - 1 + window
    whole = rows.where(F.col("settled") | equal).select("doc_id", F.col("first").alias("start"), stop.alias("stop"))
    fetched = stored(_fetched(rows.where(~F.col("settled") & wanted & F.col("differ")), docs, take, window))
    ranges_ = whole.unionByName(_resolved(fetched, resolve, window)).unionByName(_counted(fetched, earlier_only, window))
    return ranges_.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))


def with_ranges(docs: DataFrame, ranges_: DataFrame) -> DataFrame:
    """``doc_id``, ``packed`` text and ``ranges`` (null for none) of every document."""
    found = ranges_.withColumnRenamed("doc_id", "_of")
    small = packed(docs)
    return small.join(found, small["doc_id"] == found["_of"], "left").drop("_of")


def bounds_of(ranges_: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of ranges."""
    pairs = np.array([(r["start"], r["stop"]) for r in ranges_ or []], np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def mask_of(size: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of the symbols are in a range."""
    change = np.bincount(starts.clip(0, size), minlength=size + 1) - np.bincount(stops.clip(0, size), minlength=size + 1)
    return np.cumsum(change[:-1]) > 0
