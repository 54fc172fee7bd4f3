"""Substring dedup over words: prefix-partitioned suffix trees give the word windows that documents share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import Rolling, flat, ranges, slices, word_bounds, word_hashes
from landfall.llm.repeats import bounds_of, covered_ranges, mask_of, unpacked, with_ranges

WINDOW = 13
GRAM = 5
# A group of suffixes with one prefix is put in order at once up to this size; a larger one gets longer prefixes.
GROUP_SUFFIXES = 1 << 16


def word_symbols(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where the words of each text start."""
    data, offsets = flat(column, "\n")
    starts, ends = word_bounds(data)
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _words_of(text: bytes) -> np.ndarray:
    data = np.frombuffer(text + b"\n", np.uint8)
    return word_hashes(data, *word_bounds(data))


def deep_nodes(words: np.ndarray, suffixes: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Suffixes below each node of the suffix tree at ``depth`` or deeper that has several, as places in ``suffixes``.

    The suffixes are parted by their first word, and parts that are still too large by the next,
    until each fits; the subtree of a part is its sorted order with the lengths of common
    prefixes.  Parts of one suffix are leaves and can have no inner node.
    """
    work = [(np.arange(len(suffixes)), 0)]
    while work:
        group, known = work.pop()
        if len(group) > GROUP_SUFFIXES and known < depth:
            order = np.argsort(words[suffixes[group] + known], kind="stable")
            group = group[order]
            values = words[suffixes[group] + known]
            cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
            work += [(part, known + 1) for part in np.split(group, cuts) if len(part) > 1]
            continue
        rest = words[suffixes[group][:, None] + np.arange(known, depth)]
        group = group[np.lexsort(rest.T[::-1])] if rest.shape[1] else group
        rest = words[suffixes[group][:, None] + np.arange(known, depth)]
        common = (rest[1:] == rest[:-1]).all(axis=1)
        edges = np.flatnonzero(np.diff(common, prepend=False, append=False))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            yield group[first : last + 1]


def _seen_earlier(spans: list[bytes], counts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the spans that also start in a document of smaller doc_id."""
    words = np.frombuffer(b"".join(spans), np.uint64)
    sizes = counts + WINDOW - 1
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = (np.cumsum(sizes) - sizes)[row] + at
    found = np.zeros(len(row), bool)
    for node in deep_nodes(words, suffixes, WINDOW):
        own = docs[row[node]]
        found[node] = own > own.min()
    return row[found], at[found]


def _word_ranges(docs: DataFrame) -> DataFrame:
    return covered_ranges(docs, word_symbols, _words_of, _seen_earlier, WINDOW, GRAM, earlier_only=True)


def _kept_words(text: bytes, ranges_: list[dict] | None) -> tuple[int, bytes]:
    """How many words a text has, and those that no window of the ranges, nor one equal to it, covers."""
    words = text.split()
    if not ranges_:
        return len(words), b" ".join(words)
    windows = Rolling(_words_of(text)).every(WINDOW)
    starts, stops = bounds_of(ranges_)
    starts, stops = starts.clip(0, len(windows)), (stops - WINDOW + 1).clip(0, len(windows))
    seen = np.unique(windows[ranges(starts, np.maximum(stops - starts, 0))])
    again = np.flatnonzero(np.isin(windows, seen))
    removed = mask_of(len(words), again, again + WINDOW)
    return len(words), b" ".join(w for w, r in zip(words, removed) if not r)


def without_shared_windows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the other words) and ``kept_sha256`` of every document.

    A window is 13 consecutive words; a word goes if a window that covers it also starts in a
    document of smaller doc_id.  Null texts have no words.  Documents with a null doc_id
    lose nothing and others lose nothing for them.  Repeated rows give repeated rows; rows
    that share a doc_id are one document to the rule.  Other columns do not matter.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            out = []
            for text, ranges_ in zip(unpacked(batch.column("packed")).to_pylist(), batch.column("ranges").to_pylist()):
                n, kept = _kept_words(text, ranges_)
                out.append((n, n - len(kept.split()), kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            arrays[3] = arrays[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    kinds = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    return with_ranges(rows, _word_ranges(rows)).mapInArrow(run, kinds)


def shared_window_digest(docs: DataFrame) -> DataFrame:
    return without_shared_windows(docs).drop("kept")
