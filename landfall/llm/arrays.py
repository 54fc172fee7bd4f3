"""Text columns as numpy arrays: slices of bounded size, words, and rolling hashes."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What one slice may hold; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def as_array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts (or lists) have at most ``limit`` bytes (or items) together, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    give_back()


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: workers are kept for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def pieces(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """A text column in slices, as ``slices`` makes them."""
    batch = pa.RecordBatch.from_arrays([as_array(column)], ["text"])
    return (part.column("text") for part in slices(iter([batch]), "text", limit))


def flat(column, ending: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each text starts, each followed by ``ending``; null is empty."""
    texts = pc.fill_null(as_array(column), "").cast(pa.large_string())
    if ending:
        texts = pc.binary_join_element_wise(texts, *(pa.scalar(t, pa.large_string()) for t in ("", ending)))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no ASCII white space; the texts must end with white space."""
    space = SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return edges[::2], edges[1::2]


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers, each turned into one that depends on all its bits."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, U64)
    powers[0] = 1
    return np.cumprod(powers, dtype=U64)


def _room(size: int) -> int:
    return 1 << max(20, int(size).bit_length())


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray):
        room = _room(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * _powers(_BASE, room)[: len(values)], out=self.sums[1:])
        self.back = _powers(_INVERSE, room)

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.raw(starts, ends))

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of that length, by its start."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:-length]) * self.back[:n]) if n > 0 else np.zeros(0, U64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling(BYTE_VALUES[data]).of(starts, ends)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + length - 1``, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


# 0: white space, 1: letters, digits and all bytes beyond ASCII, 2: the rest.
CLASS = np.full(256, 2, np.uint8)
CLASS[SPACE] = 0
CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def token_hashes(column, stem_bytes: int = 0) -> tuple[np.ndarray, ...]:
    """Hashes of the tokens of all texts in a row, and where the tokens of each text start, with the end.

    A token is a run of word bytes or of marks; A-Z are read as a-z.  With ``stem_bytes``
    also the hashes of the first bytes of longer tokens (0 for others), in the middle.
    """
    data, offsets = flat(column, "\n")
    if not len(data):
        empty = np.zeros(0, U64)
        return (empty, empty, np.zeros_like(offsets)) if stem_bytes else (empty, np.zeros_like(offsets))
    kinds = CLASS[data]
    edges = np.concatenate([[0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1, [len(data)]])
    starts, ends = edges[:-1], edges[1:]
    full = kinds[starts] != 0
    starts, ends = starts[full], ends[full]
    firsts, rolling = np.searchsorted(starts, offsets), Rolling(BYTE_VALUES[LOWER[data]])
    hashes = rolling.of(starts, ends)
    if not stem_bytes:
        return hashes, firsts
    stems = np.where(ends - starts > stem_bytes, rolling.of(starts, np.minimum(ends, starts + stem_bytes)), U64(0))
    return hashes, stems, firsts


def sums_by(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the stretches that start at ``firsts``, the last of which is the end."""
    running = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return running[firsts[1:]] - running[firsts[:-1]]
