"""Token ids of a corpus in files of independent blocks, packed by a static range asymmetric numeral system.

A corpus folder holds ``frequencies`` (one table for all blocks) and ``blocks``.  A block has whole
documents, in order of their ids.  Its tokens are dealt in turn to a number of lanes,
each a state of its own, that share one stream of 32-bit words: all lanes advance at
once.  A block's row says where it stands (part, number, first token in the part) and
which documents it has, so any block can be read alone; a checksum guards it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.arrays import slices
from landfall.llm.byte_bpe import cutter, default_tokenizer
from landfall.llm.tables import share_of_hash, stored
from landfall.session import workspace

END = 2
PRECISION = 20
LOW = np.uint64(1 << 31)
BLOCK_TOKENS = 1 << 20
PART_TOKENS = 1 << 23
LANES = 2048
SLICE_BYTES = 3 << 20
# Documents looked at for an order of ids in which they pack well; any order gives the same files.
ORDER_DOCS = 500
MAGIC = b"LFTB"
HEAD = struct.Struct("<4sQII")  # mark, tokens, lanes, words
WORD = np.uint64(32)
BITS = np.uint64(PRECISION)
MASK = np.uint64((1 << PRECISION) - 1)
BLOCK_COLUMNS = (
    "part bigint, block bigint, first_token bigint, n_tokens bigint, "
    "doc_ids array<bigint>, doc_tokens array<bigint>, packed binary"
)


def shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2 ** PRECISION, at least one for each symbol that occurs."""
    total, slots = int(counts.sum()), 1 << PRECISION
    if (counts > 0).sum() * 2 > slots:
        raise ValueError("too many symbols for the precision of the table")
    if not total:
        return np.zeros(len(counts), np.int64)
    exact = counts * ((slots - (counts > 0).sum()) / total)
    floor = np.floor(exact).astype(np.int64)
    left = slots - int((floor + (counts > 0)).sum())
    order = np.lexsort((np.arange(len(counts)), -(exact - floor)))
    order = order[counts[order] > 0]
    floor[order[np.arange(left) % len(order)]] += 1 if left <= len(order) else 0
    if left > len(order):
        floor[int(counts.argmax())] += left
    return floor + (counts > 0)


class Table:
    """Frequencies, where each symbol's slots start, and the symbol of each slot."""

    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.start = (np.cumsum(frequencies) - frequencies).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.int32), frequencies)

    def pack(self, ids: np.ndarray) -> bytes:
        lanes = int(min(LANES, max(1, len(ids) // 256)))
        steps = -(-len(ids) // lanes)
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        for step in range(steps - 1, -1, -1):
            own = ids[step * lanes : (step + 1) * lanes]
            x, f = state[: len(own)], self.frequency[own]
            full = x >= f << np.uint64(63 - PRECISION)
            words.append(x[full].astype(np.uint32))
            x = np.where(full, x >> WORD, x)
            whole = x // f
            state[: len(own)] = (whole << BITS) + (x - whole * f) + self.start[own]
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        body = HEAD.pack(MAGIC, len(ids), lanes, len(stream)) + state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()
        return body + struct.pack("<I", zlib.crc32(body))

    def unpack(self, packed: bytes) -> np.ndarray:
        mark, n, lanes, size = HEAD.unpack_from(packed)
        if mark != MAGIC or zlib.crc32(packed[:-4]) != struct.unpack("<I", packed[-4:])[0]:
            raise ValueError("a block of token ids is damaged")
        state = np.frombuffer(packed, "<u8", lanes, HEAD.size).astype(np.uint64)
        stream = np.frombuffer(packed, "<u4", size, HEAD.size + 8 * lanes).astype(np.uint64)
        ids, read = np.empty(n, np.int32), 0
        for first in range(0, n, lanes):
            x = state[: min(lanes, n - first)]
            slot = x & MASK
            own = self.symbol[slot.astype(np.int64)]
            ids[first : first + len(x)] = own
            x = self.frequency[own] * (x >> BITS) + slot - self.start[own]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << WORD) | stream[read : read + len(low)]
            read += len(low)
            state[: len(x)] = x
        return ids


@lru_cache(maxsize=1)
def _table(frequencies: bytes) -> Table:
    return Table(np.frombuffer(frequencies, np.int64))


def frequent_first(docs: DataFrame, tokenizer: str, end: int) -> np.ndarray:
    """All ids, those of a small sample of documents first, the most frequent before others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, n = np.unique(cutter(tokenizer).encode(batch.column("text"))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["id", "n"])

    share = ORDER_DOCS / max(1, docs.count())
    sample = docs.where(share_of_hash(F.col("doc_id")) < share).select(F.col("text").cast("string").alias("text"))
    found = sample.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(max(cutter(tokenizer).size, end + 1), np.int64)
    counts[found["id"].astype("int64")] = found["n"]
    return np.argsort(-counts, kind="stable").astype(np.int32)


def token_rows(docs: DataFrame, tokenizer: str, end: int, order: np.ndarray) -> DataFrame:
    """``doc_id`` and the compressed ids of the whole text with the end id, as they come.

    Each id is written as its place in ``order``, low bytes apart from high ones.
    """
    held = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, place = zstandard.ZstdCompressor(level=3), np.empty(len(held.value), np.int64)
        place[held.value] = np.arange(len(place))
        kind = np.dtype("<u2" if len(place) <= 65536 else "<u4")
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, counts = cutter(tokenizer).encode(batch.column("text"))
            ends = np.cumsum(counts)
            own = [place[np.append(ids[e - c : e], end)].astype(kind) for c, e in zip(counts, ends)]
            packed = [pack.compress(x.view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()) for x in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts + 1), pa.array(packed, pa.binary())], ["doc_id", "n", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, ids binary")


def _unpacked(batch: pa.RecordBatch, order: np.ndarray) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    for n, packed in zip(batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
        planes = np.frombuffer(unpack.decompress(packed), np.uint8).reshape(-1, n)
        yield order[planes.T.copy().view(f"<u{len(planes)}").ravel()]


def _all_counts(rows: DataFrame, order: np.ndarray) -> np.ndarray:
    """How often each id occurs in all rows."""
    held = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(held.value), np.int64)
        for batch in batches:
            for ids in _unpacked(batch, held.value):
                np.add(counts, np.bincount(ids, minlength=len(counts)), out=counts)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["id", "n"])

    found = rows.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(order), np.int64)
    counts[found["id"].astype("int64")] = found["n"]
    return counts


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END) -> None:
    """Writes the ids of all texts, in ascending order of doc_id, below ``path``.

    Frequencies are counted over all tokens; the table has one row for each id of the
    vocabulary and so a fixed bound.  Null texts are empty and have the end id alone; a null
    doc_id comes first; rows that repeat a doc_id are all written.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    order = frequent_first(docs, tokenizer, end)
    rows = stored(token_rows(docs, tokenizer, end, order))
    counts = _all_counts(rows, order)
    frequency = shares(counts)
    spark.createDataFrame(
        [(k, int(f)) for k, f in enumerate(frequency) if f], "id bigint, frequency bigint"
    ).coalesce(1).write.parquet(f"{path}/frequencies")
    held = spark.sparkContext.broadcast((frequency.tobytes(), order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = _table(held.value[0]), TaskContext.get().partitionId()
        block, first, docs_, lists, total = 0, 0, [], [], 0

        def packed() -> pa.RecordBatch:
            sizes = [len(x) for x in lists]
            values = [[part], [block], [first], [total], [docs_], [sizes], [table.pack(np.concatenate(lists))]]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            names = ["part", "block", "first_token", "n_tokens", "doc_ids", "doc_tokens", "packed"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _unpacked(batch, held.value[1])):
                docs_.append(doc_id)
                lists.append(ids)
                total += len(ids)
                if total >= BLOCK_TOKENS:
                    yield packed()
                    block, first, docs_, lists, total = block + 1, first + total, [], [], 0
        if lists:
            yield packed()

    parts = max(1, -(-int(counts.sum()) // PART_TOKENS))
    # Dealt by the id alone: the sample that finds the borders of the parts goes to the driver.
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "n", "ids")
    dealt.mapInArrow(run, BLOCK_COLUMNS).write.option("compression", "none").parquet(f"{path}/blocks")


def _read(spark: SparkSession, path: str, columns: list[tuple[str, str, pa.DataType]], values: Callable) -> DataFrame:
    """Rows of documents, with ``values`` of their ids, block by block.

    Only how many tokens each part has, a row for eight million tokens, comes to the driver.
    """
    table = spark.read.parquet(f"{path}/frequencies").toPandas()
    frequency = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.int64)
    frequency[table["id"]] = table["frequency"]
    blocks = spark.read.schema(BLOCK_COLUMNS).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").toPandas()
    before = dict(zip(sizes["part"].tolist(), (sizes["n"].cumsum() - sizes["n"]).tolist()))
    held = spark.sparkContext.broadcast((frequency.tobytes(), before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies, parts = held.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = _table(frequencies).unpack(one["packed"])
                counts = np.array(one["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                starts = parts[one["part"]] + one["first_token"] + ends - counts
                own = [values(ids[e - c : e]) for c, e in zip(counts.tolist(), ends.tolist())]
                arrays = [pa.array(one["doc_ids"], pa.int64()), pa.array(starts), pa.array(counts)]
                arrays += [pa.array([v[k] for v in own], kind) for k, (_, _, kind) in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", *(c[0] for c in columns)])

    kinds = "".join(f", {name} {kind}" for name, kind, _ in columns)
    return blocks.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint{kinds}")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before it), ``n_tokens`` and ``ids`` of every document."""
    return _read(spark, path, [("ids", "array<int>", pa.list_(pa.int32()))], lambda ids: (ids,))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files``, with ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers in their place."""
    return _read(spark, path, [("ids_crc32", "bigint", pa.int64())], lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),))


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the files of ``docs``, in the shared folder unless ``path`` is given, and reads their checksums back."""
    path = path or workspace(docs.sparkSession)
    write_token_files(docs, path)
    return read_checksums(docs.sparkSession, path)
