"""SentencePiece encoding and decoding by a Viterbi search over many words at once.

Words of one length advance together.  For each end position the hashes of the
substrings that end there are looked up among the sorted hashes of all pieces, and the
best way to reach the position is stored as the length of its last piece.  In a
unigram model the way with the largest sum of scores is best.  In a merge (BPE) model
the last piece of every beginning of a word is unique: it is the one that merges leave
standing beside the last piece before it.  So the same search, held to such pairs,
gives just what merging pair after pair gives.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.arrays import U64, Rolling, as_array, mixed, ranges, slices
from landfall.llm.units import UnitCache, points_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Longer words are merged one by one.
LONGEST = 48
NEVER = np.iinfo(np.int64).max
PAIRS_KEPT = 1 << 20
UNIT_CACHE = 400_000
# Text encoded at once: words of one length are searched together, so larger slices take fewer searches.
SLICE_BYTES = 2 << 20
# Ids decoded at once.
DECODED_IDS = 1 << 18


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """The pieces of a model file, ready for lookups."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, kind = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model rewrites texts before it cuts them")
        self.prefix = " " if spec.add_dummy_prefix else ""
        self.unigram = proto.trainer_spec.model_type == 1
        self.size = len(proto.pieces)
        self.unknown = next(k for k, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        self.byte_ids = np.full(256, self.unknown, np.int32)
        self.ids: dict[str, int] = {}
        self.scores = np.zeros(self.size)
        self.bytes = [b""] * self.size
        for k, p in enumerate(proto.pieces):
            self.scores[k] = p.score
            if p.type == kind.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_ids[value] = k
                self.bytes[k] = bytes([value])
            elif p.type == kind.UNKNOWN:
                self.bytes[k] = " ⁇ ".encode()
            elif p.type in (kind.NORMAL, kind.USER_DEFINED):
                if SPACE in p.piece.lstrip(SPACE):
                    raise ValueError("a piece goes over the start of a word")
                self.ids[p.piece] = k
                self.bytes[k] = p.piece.replace(SPACE, " ").encode()
        self.rank = np.zeros(self.size + 1, np.int64)
        self.rank[:-1] = np.unique(-self.scores, return_inverse=True)[1]
        self.longest = max(map(len, self.ids), default=1)
        self.letters = {c for piece in self.ids for c in piece if c in self.ids}
        usable = list(self.ids.items())
        if not self.unigram:
            self._learn_merges()
            usable = [(p, k) for p, k in usable if self.standing[k]]
        keys = np.array([_key(p) for p, _ in usable], U64)
        order = np.argsort(keys)
        self.keys, self.by_key = keys[order], np.array([k for _, k in usable], np.int64)[order]
        # Which leading bits any key has: most substrings are ruled out without a search.
        self.key_heads = np.zeros(1 << 20, bool)
        self.key_heads[(keys >> U64(44)).astype(np.int64)] = True
        lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.byte_starts, self.byte_lengths = np.cumsum(lengths) - lengths, lengths
        self.all_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)

    def merged(self, symbols: list[str]) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """Symbols after all merges, best first and from the left, and the last merge behind each."""
        before, after = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        alive, made, queue = [True] * len(symbols), {}, []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < len(symbols) and (k := self.ids.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(queue, (-self.scores[k], i, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or symbols[i] != left or j >= len(symbols) or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = left + right, False, after[j]
            made[left + right] = (left, right)
            if after[j] < len(symbols):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s, a in zip(symbols, alive) if a], made

    def _learn_merges(self) -> None:
        none = self.size
        self.left, self.right = np.full(none + 1, none), np.full(none + 1, none)
        self.standing, self.regular = np.zeros(none + 1, bool), np.ones(none + 1, bool)
        pairs, results = [], []
        for piece, k in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs.append(a * self.size + b)
                    results.append(k)
            left, made = self.merged(list(piece))
            self.standing[k] = left == [piece]
            if len(piece) == 1 or not self.standing[k]:
                self.regular[k] = len(piece) == 1
                continue
            a, b = (self.ids.get(part) for part in made[piece])
            # Undoing merges from the last one back needs each to come after those of its parts.
            if a is None or b is None or max(self.rank[a] * (len(made[piece][0]) > 1), self.rank[b] * (len(made[piece][1]) > 1)) >= self.rank[k]:
                self.regular[k] = False
            else:
                self.left[k], self.right[k] = a, b
        order = np.argsort(pairs)
        self.pairs, self.pair_result = np.array(pairs)[order], np.array(results)[order]
        self.kept_pairs = np.full(PAIRS_KEPT, -1, np.int64)
        self.kept_answers = np.zeros(PAIRS_KEPT, bool)
        odd = sorted((p for p, k in self.ids.items() if self.standing[k] and not self.regular[k]), key=len)
        self.odd: list[str] = []
        for piece in odd:
            if not any(shorter in piece for shorter in self.odd):
                self.odd.append(piece)

    def side_by_side(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether merges leave each pair of pieces as it is; answers are kept for the next time."""
        key = one * self.size + other
        place = (mixed(key.astype(U64)) & U64(PAIRS_KEPT - 1)).astype(np.int64)
        new = self.kept_pairs[place] != key
        if new.any():
            asked, which = np.unique(key[new], return_index=True)
            at = place[new][which]
            answers = self._stand(asked // self.size, asked % self.size)
            result = np.empty(len(key), bool)
            result[~new] = self.kept_answers[place[~new]]
            result[new] = answers[np.searchsorted(asked, key[new])]
            self.kept_pairs[at], self.kept_answers[at] = asked, answers
            # Two pairs at one place: the one written last stays, with its own answer.
            self.kept_answers[at] = answers[np.searchsorted(asked, self.kept_pairs[at])]
            return result
        return self.kept_answers[place]

    def _stand(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Undoes the merges at the border from the last back; no merge over the border may have come before the one undone."""
        one, other, stands = one.copy(), other.copy(), np.ones(len(one), bool)
        limit = np.full(len(one), NEVER)
        open_ = np.arange(len(one))
        while len(open_):
            a, b = one[open_], other[open_]
            key = a * self.size + b
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            over = np.where(self.pairs[place] == key, self.rank[self.pair_result[place]], NEVER)
            crossed = over < limit[open_]
            stands[open_[crossed]] = False
            rank_a = np.where(self.right[a] < self.size, self.rank[a], -1)
            rank_b = np.where(self.left[b] < self.size, self.rank[b], -1)
            first = rank_a > rank_b
            one[open_] = np.where(first, self.right[a], a)
            other[open_] = np.where(first, b, self.left[b])
            # Of equal merges the left one comes first.
            limit[open_] = np.where(first, rank_a, rank_b + 1)
            open_ = open_[~crossed & (np.maximum(rank_a, rank_b) >= 0)]
        return stands

    def _pieces_at(self, rolling: Rolling, n: int, size: int, length: int) -> np.ndarray:
        """The piece of that length at each place of each word, -1 for none, by place."""
        starts = (np.arange(n)[:, None] * size + np.arange(size - length + 1)).ravel()
        key = rolling.raw(starts, starts + length)
        found = np.full(len(starts), -1, np.int64)
        maybe = np.flatnonzero(self.key_heads[(key >> U64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        hit = self.keys[place] == key[maybe]
        found[maybe[hit]] = self.by_key[place[hit]]
        return np.ascontiguousarray(found.reshape(n, -1).T)

    def search(self, words: list[str]) -> list[np.ndarray]:
        """Viterbi search for words of one length, all of whose characters are pieces."""
        n, size = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        rolling = Rolling(mixed(points.astype(U64) + U64(0x51)))
        pieces = [self._pieces_at(rolling, n, size, length) for length in range(1, min(size, self.longest) + 1)]
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        last, back = np.zeros((size + 1, n), np.int64), np.zeros((size + 1, n), np.int64)
        for end in range(1, size + 1):
            for length in range(1, min(end, self.longest) + 1):
                start = end - length
                piece = pieces[length - 1][start]
                possible = (piece >= 0) & (best[start] > -np.inf)
                if not self.unigram:
                    possible &= best[end] == -np.inf
                ok = np.flatnonzero(possible)
                if not len(ok):
                    continue
                piece = piece[ok]
                if start and not self.unigram:
                    stand = self.side_by_side(last[start, ok], piece)
                    ok, piece = ok[stand], piece[stand]
                value = best[start, ok] + self.scores[piece]
                better = value > best[end, ok]
                ok, piece = ok[better], piece[better]
                best[end, ok], last[end, ok], back[end, ok] = value[better], piece, length
        ids, count = np.zeros((size, n), np.int32), np.zeros(n, np.int64)
        place, column = np.full(n, size), np.arange(n)
        while (place > 0).any():
            some = place > 0
            count[some] += 1
            ids[size - count[some], column[some]] = last[place[some], column[some]]
            place = place - back[place, column] * some
        return [ids[size - c :, k] for k, c in enumerate(count.tolist())]

    def encode(self, units: list[str]) -> list[np.ndarray]:
        """Ids of units that merges do not go beyond."""
        ids: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        words = [unit.replace(" ", SPACE) for unit in units]
        for k, word in enumerate(words):
            if not self.letters.issuperset(word):
                ids[k] = self._in_parts(word)
            elif not self.unigram and (len(word) > LONGEST or any(odd in word for odd in self.odd)):
                ids[k] = np.array([self.ids[s] for s in self.merged(list(word))[0]], np.int32)
            else:
                by_length.setdefault(len(word), []).append(k)
        for own in by_length.values():
            for first in range(0, len(own), 4096):
                part = own[first : first + 4096]
                for k, found in zip(part, self.search([words[k] for k in part])):
                    ids[k] = found
        return ids

    def _in_parts(self, word: str) -> np.ndarray:
        """Ids of a word with letters that are no pieces: these are given by their bytes, and part the rest."""
        parts = _split(word, self.letters)
        known = iter(self.encode([p for p in parts if p[0] in self.letters]))
        return np.concatenate([next(known) if p[0] in self.letters else self._as_bytes(p) for p in parts])

    def _as_bytes(self, letter: str) -> np.ndarray:
        return self.byte_ids[np.frombuffer(letter.encode(), np.uint8)]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of stretches of ids; one space at the start of a text is the model's own."""
        lengths = self.byte_lengths[ids]
        data = self.all_bytes[ranges(self.byte_starts[ids], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        raw, skip = data.tobytes(), len(self.prefix)
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return pa.array([t[skip:] if t[:skip] == self.prefix else t for t in texts], pa.string())


def _key(piece: str) -> int:
    points = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
    return int(Rolling(mixed(points.astype(U64) + U64(0x51))).raw(np.array([0]), np.array([len(points)]))[0])


def _split(unit: str, letters: set[str]) -> list[str]:
    if letters.issuperset(unit):
        return [unit]
    parts, start = [], 0
    for k, letter in enumerate(unit):
        if letter not in letters:
            if k > start:
                parts.append(unit[start:k])
            parts.append(letter)
            start = k + 1
    return [*parts, unit[start:]] if start < len(unit) else parts


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[Pieces, UnitCache]:
    pieces = Pieces(path)
    return pieces, UnitCache(pieces.encode, UNIT_CACHE)


def encode_column(column, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each text has."""
    pieces, cache = _coder(path)
    texts = pc.fill_null(as_array(column), "").cast(pa.large_string())
    prefix = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pieces.prefix).cast(pa.large_string())
    text, points, offsets = points_of(pc.binary_join_element_wise(prefix, texts, pa.scalar("", pa.large_string())))
    # White space is read as the sign that stands for it, so that sign is white space, too.
    text, points = text.replace(SPACE, " "), np.where(points == ord(SPACE), 0x20, points)
    space, line = points == 0x20, points == 0x0A
    first = np.zeros(len(points) + 1, bool)
    first[1:-1] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    first[offsets] = True
    starts = np.flatnonzero(first[:-1])
    ids, sizes = cache.encoded(text, points, starts, np.append(starts[1:], len(points)))
    total = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]
    return ids, np.diff(total)


def list_array(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the piece numbers of the whole text.

    ``model`` is the path of a model file that every executor has.  A null or empty text
    has no ids.  A column ``ids`` of ``docs`` is replaced, others are kept; rows may repeat.
    """
    path = model or default_model()
    rows = docs.drop("ids").withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, counts = encode_column(batch.column("text"), path)
            yield pa.RecordBatch.from_arrays([*batch.columns, list_array(ids, counts)], [*batch.schema.names, "ids"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` with ``text`` put together from ``ids``; null ids give an empty text."""
    path = model or default_model()
    kept = rows.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", DECODED_IDS):
            ids = batch.column("ids")
            counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            texts = _coder(path)[0].decode(ids.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())]))


def encoding_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Every text encoded and decoded again, as ``doc_id``, ``n_tokens``, ``ids_crc32`` and ``round_trip``.

    ``ids_crc32`` is the checksum of the ids as little-endian 32-bit integers; ``round_trip`` says
    whether decoding gave the text (a null one as empty; U+2581 comes back as a space).
    Repeated rows give repeated rows; a null doc_id stays null; other columns do not matter.
    """
    path = model or default_model()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            values, counts = encode_column(batch.column("text"), path)
            same = pc.equal(_coder(path)[0].decode(values, counts), pc.fill_null(batch.column("text"), ""))
            values, ends = values.astype("<u4"), np.cumsum(counts)
            sums = [zlib.crc32(values[e - c : e].tobytes()) for c, e in zip(counts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(sums, pa.int64()), same],
                ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    # Both ways in one step: a step of its own would hold a second Python worker for each task.
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean")
