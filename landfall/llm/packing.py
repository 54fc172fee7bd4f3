"""Documents packed into training sequences of one length, online, by the sum-of-squares rule.

A task packs the documents of its part of the input as they come.  A level array counts the
partially filled windows by how full they are.  What a document has beyond whole windows
goes into the fill level that leaves the least sum of squared counts, so no level
gathers windows that nothing fits.  Windows still open at the end are completed by cutting some
of their pieces; less than one window remains, and the remains of many tasks are packed together.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import slices
from landfall.llm.byte_bpe import cutter, default_tokenizer
from landfall.llm.tables import stored

WINDOW = 2048
END = 1
# Tokens a task holds in open windows; beyond that it completes them and opens new ones.
OPEN_TOKENS = 1 << 22
SLICE_BYTES = 3 << 20
# Tasks whose remains, less than a window each, are packed by one task.
REMAINS = 1024
SHARD_BITS, LEVEL_BITS = 32, 56
ROWS = 4096
NONE = 1 << 40


@dataclass(frozen=True, slots=True)
class Piece:
    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Piece, Piece]:
        """The first ``at`` ids, and the rest."""
        return (
            Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:at]),
            Piece(self.doc_id, self.doc_tokens, self.start + at, self.ids[at:]),
        )


class Packer:
    """Windows of ``window`` tokens that are filled piece by piece.

    ``closed`` has the full windows so far; whoever reads them may empty it.
    """

    def __init__(self, window: int = WINDOW, open_tokens: int = OPEN_TOKENS):
        self.window, self.open_tokens = window, open_tokens
        self.closed: list[list[Piece]] = []
        self._clear()

    def _clear(self) -> None:
        self.levels: list[list[list[Piece]]] = [[] for _ in range(self.window)]
        self.held = 0
        # What one window more, or one less, at a level adds to the sum of squares.  A full window is not
        # counted, nor an empty one; a level without windows has none to give.
        self.more = np.ones(self.window + 1, np.int64)
        self.less = np.full(self.window + 1, NONE)
        self.more[self.window] = self.less[0] = 0

    def _counted(self, level: int) -> None:
        n = len(self.levels[level])
        self.more[level] = 2 * n + 1
        self.less[level] = 1 - 2 * n if n else NONE

    def level_for(self, size: int) -> int:
        """The level, 0 for a new window, whose choice leaves the least sum of squares; of several the fullest."""
        change = self.less[: self.window - size + 1] + self.more[size:]
        return len(change) - 1 - int(change[::-1].argmin())

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.window:
            full, piece = piece.cut(self.window)
            self.closed.append([full])
        size = len(piece.ids)
        if not size:
            return
        level = self.level_for(size)
        pieces = self.levels[level].pop() if level else []
        if level:
            self._counted(level)
        pieces.append(piece)
        if level + size == self.window:
            self.closed.append(pieces)
            self.held -= level
        else:
            self.levels[level + size].append(pieces)
            self._counted(level + size)
            self.held += size
        if self.held > self.open_tokens:
            self.complete()

    def complete(self) -> None:
        """Fills the fullest open windows with pieces of the emptiest, cut where they are too long, until one is left."""
        left = deque((level, pieces) for level in range(self.window - 1, 0, -1) for pieces in self.levels[level])
        while len(left) > 1:
            fill, pieces = left.popleft()
            while fill < self.window and left:
                rest, giver = left.pop()
                piece = giver.pop()
                if len(piece.ids) > self.window - fill:
                    piece, kept = piece.cut(self.window - fill)
                    giver.append(kept)
                pieces.append(piece)
                fill += len(piece.ids)
                if giver:
                    left.append((rest - len(piece.ids), giver))
            if fill == self.window:
                self.closed.append(pieces)
            else:
                left.append((fill, pieces))
        self._clear()
        for fill, pieces in left:
            self.levels[fill].append(pieces)
            self._counted(fill)
            self.held = fill

    def remains(self) -> list[Piece]:
        """The pieces of the one window that cannot be filled."""
        self.complete()
        pieces = [piece for level in self.levels for own in level for piece in own]
        self._clear()
        return pieces


def in_powers_of_two(pieces: Iterable[Piece]) -> Iterator[list[Piece]]:
    """Sequences whose lengths are the powers of two that add up to that of all pieces, longest first."""
    left = deque(pieces)
    total = sum(len(p.ids) for p in left)
    while total:
        length = 1 << (total.bit_length() - 1)
        total -= length
        own: list[Piece] = []
        while length:
            piece = left.popleft()
            if len(piece.ids) > length:
                piece, kept = piece.cut(length)
                left.appendleft(kept)
            own.append(piece)
            length -= len(piece.ids)
        yield own


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "remains", "ids"]
KINDS = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, remains bigint, ids binary"


class _Rows:
    """Pieces as record batches; ``remains`` is the task that left them, null for those of a sequence."""

    def __init__(self, first_sequence: int, with_ids: bool):
        self.next, self.with_ids, self.rows = first_sequence, with_ids, []

    def sequence(self, pieces: list[Piece], remains: int | None = None) -> None:
        offset = 0
        for p in pieces:
            ids = p.ids.astype("<u4").tobytes()
            held = ids if self.with_ids or remains is not None else None
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(ids), p.doc_tokens, self.next, offset, remains, held))
            offset += len(p.ids)
        self.next += 1

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = list(zip(*self.rows))
            kinds = [pa.int64()] * 8 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)
            self.rows = []


def packed(docs: DataFrame, tokenizer: str | None = None, end: int = END, window: int = WINDOW, open_tokens: int = OPEN_TOKENS, with_ids: bool = False) -> DataFrame:
    """The ids of all texts, each text's followed by ``end``, in sequences of ``window`` ids.

    Returns a row for each piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids_crc32`` (of
    the ids as little-endian unsigned 32-bit integers), ``doc_tokens`` (ids of its document), ``sequence_id`` and
    ``offset`` (its place there).  With ``with_ids`` also ``ids``, those integers themselves.

    All sequences are full but the last few of each thousand tasks: their lengths are powers of two, so nothing is
    padded.  A null text is empty, and a text without ids has ``end`` alone; rows that repeat a doc_id, or have
    none, are documents of their own; other columns do not matter.  A task holds at most ``open_tokens`` ids in
    open windows, whatever the lengths; sequence ids are unique, not dense.
    """
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        packer, out = Packer(window, open_tokens), _Rows(shard << SHARD_BITS, with_ids)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, counts = cutter(path).encode(batch.column("text"))
            ends = np.cumsum(counts)
            for doc_id, s, e in zip(batch.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                packer.add(Piece(doc_id, e - s + 1, 0, np.append(ids[s:e], end)))
                while packer.closed:
                    out.sequence(packer.closed.pop())
            yield from out.batches(ROWS)
        left = packer.remains()
        for pieces in packer.closed:
            out.sequence(pieces)
        out.sequence(left, shard)
        yield from out.batches()

    def pack_remains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("group", "doc_id", "doc_tokens", "start", "ids"))
            for number, doc_id, tokens, start, ids in zip(*columns):
                if number != group:
                    if group is not None:
                        yield from finished(packer, out)
                    group, packer = number, Packer(window, open_tokens)
                    out = _Rows((1 << LEVEL_BITS) + (group << SHARD_BITS), with_ids)
                packer.add(Piece(doc_id, tokens, start, np.frombuffer(ids, "<u4")))
        if group is not None:
            yield from finished(packer, out)

    def finished(packer: Packer, out: _Rows) -> Iterator[pa.RecordBatch]:
        left = packer.remains()
        for pieces in [*packer.closed, *in_powers_of_two(left)]:
            out.sequence(pieces)
        yield from out.batches()

    first = stored(rows.mapInArrow(pack, KINDS))
    rest = first.where("remains is not null").withColumn("group", F.expr(f"remains div {REMAINS}"))
    rest = rest.repartition("group").sortWithinPartitions("group", "remains", "offset").mapInArrow(pack_remains, KINDS)
    pieces = first.where("remains is null").unionByName(rest).drop("remains")
    return pieces if with_ids else pieces.drop("ids")
