"""Benchmark items found in documents: BM25 with block-max bounds, then overlap of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.arrays import LOWER, Rolling, flat, pieces, ranges, slices, token_hashes, word_bounds, word_hashes
from landfall.llm.tables import stored

K1, B = 1.2, 0.75
# A passage is looked at more closely if its BM25 score for an item is at least this part of the item's own.
LEAST_SCORE = 0.5
BLOCK_ITEMS = 2
# What the commonest terms together may add to the score of an item; bounds take it for granted.
COMMON_SCORE = 0.05
SHINGLE_WORDS = 5
LEAST_OVERLAP = 0.8
# The last part of an item's words, its answer, is also reported apart from the rest.
ANSWER_PART = 0.25
OVERLAPS = ("overlap", "question", "answer")
# Bytes of item texts in one index; more items make more indexes, each for a pass of its own.
INDEX_BYTES = 32 << 20
SUMS = 1 << 22
MARKS = 1 << 25


@dataclass
class Postings:
    """For each term a list of places with weights."""

    first: np.ndarray
    place: np.ndarray
    weight: np.ndarray

    def expanded(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of the terms, one after the other: which it was, and its places and weights."""
        counts = self.first[terms + 1] - self.first[terms]
        at = ranges(self.first[terms], counts)
        return np.repeat(np.arange(len(terms)), counts), self.place[at], self.weight[at]


def _postings(term: np.ndarray, place: np.ndarray, weight: np.ndarray, terms: int) -> Postings:
    order = np.lexsort((place, term))
    return Postings(np.searchsorted(term[order], np.arange(terms + 1)), place[order], weight[order])


@dataclass
class Among:
    """What BM25 asks of all items: how many there are, their mean length, and how many have each term of an index."""

    items: int
    mean_length: float
    terms: np.ndarray
    counts: np.ndarray

    def frequencies(self, terms: np.ndarray) -> np.ndarray:
        order = np.argsort(self.terms)
        return self.counts[order][np.searchsorted(self.terms[order], terms)]


class Index:
    """Inverted index of items.  A weight is what a term adds to the score of an item, as a part of the item's own score."""

    def __init__(self, ids: list[int], texts: list[str], among: Among | None = None):
        hashes, firsts = token_hashes(pa.array(texts, pa.string()))
        owner = np.repeat(np.arange(len(ids)), np.diff(firsts))
        self.ids = np.array(ids, np.int64)
        self.terms, term = np.unique(hashes, return_inverse=True)
        pairs, tf = np.unique(np.stack([term, owner]), axis=1, return_counts=True)
        term, item = pairs
        lengths = np.diff(firsts).astype(float)
        df, n, mean = np.bincount(term, minlength=len(self.terms)), len(ids), lengths.sum() / max(len(ids), 1)
        if among:
            df, n, mean = among.frequencies(self.terms), among.items, among.mean_length
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / max(mean, 1)))
        weight = weight / np.bincount(item, weight, len(ids))[item]
        self.items = _postings(term, item, weight, len(self.terms))
        block = item // BLOCK_ITEMS
        keys, which = np.unique(np.stack([term, block]), axis=1, return_inverse=True)
        most = np.zeros(keys.shape[1])
        np.maximum.at(most, which.ravel(), weight)
        self.blocks = _postings(keys[0], keys[1], most, len(self.terms))
        self.most = np.zeros(len(self.terms))
        np.maximum.at(self.most, term, weight)
        self._set_common_terms_apart(term, item, weight)
        self.n_blocks = -(-len(ids) // BLOCK_ITEMS)
        # Half a passage is as long as the longest item, so that some passage holds any copy whole.
        self.half = int(max(16, lengths.max(initial=0)))
        self.heads = np.zeros(1 << 20, bool)
        self.heads[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        self.parts = [_item_parts(text) for text in texts]
        self.shingle_words = [min(SHINGLE_WORDS, len(_split(text))) for text in texts]
        keys, at = term * len(ids) + item, [np.searchsorted(self.terms, token_hashes(_words(t))[0]) for t in texts]
        left = [self._score_left(k, t, weight[np.searchsorted(keys, at[k] * len(ids) + k)]) for k, t in enumerate(texts)]
        # What a passage has to score, so that none with enough shingles of an item is passed over.
        self.least = min([LEAST_SCORE, *left]) - 1e-9

    def _set_common_terms_apart(self, term: np.ndarray, item: np.ndarray, weight: np.ndarray) -> None:
        """Marks terms that need not be looked at for bounds: with all of them no item gains more than ``slack``."""
        rank = np.argsort(np.argsort(self.most, kind="stable"), kind="stable")
        order = np.lexsort((rank[term], item))
        running = np.cumsum(weight[order])
        first = np.searchsorted(item[order], np.arange(len(self.ids)))
        within = running - np.concatenate([[0], running])[first][item[order]]
        too_much = within > COMMON_SCORE
        limit = int(rank[term[order][too_much]].min()) if too_much.any() else len(self.terms)
        self.telling = rank >= limit
        self.slack = float(within[~too_much].max(initial=0.0)) if len(within) else 0.0

    def _score_left(self, item: int, text: str, weight: np.ndarray) -> float:
        """What is left of an item's score when each shingle that may be missing takes one word with it, the heaviest first."""
        _, firsts = token_hashes(_words(text))
        heaviest = np.sort(np.diff(np.concatenate([[0.0], np.cumsum(weight)])[firsts]))[::-1]
        return 1 - float(heaviest[: int((1 - LEAST_OVERLAP) * len(self.parts[item][0]) + 1e-9)].sum())

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the tokens are terms, and the terms they are."""
        maybe = np.flatnonzero(self.heads[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
        hit = self.terms[place] == hashes[maybe]
        return maybe[hit], place[hit]


def _split(text: str) -> list[str]:
    """Words between ASCII white space, of items as of documents."""
    return [word.decode() for word in text.encode().split()]


def _shingles(text: str | None, length: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the stretches of so many words, or of all words where there are fewer."""
    data, _ = flat(pa.array([text or ""], pa.string()), "\n")
    words = word_hashes(LOWER[data], *word_bounds(data))
    return Rolling(words).every(min(length, max(1, len(words)))) if len(words) else words


def _words(text: str) -> pa.Array:
    return pa.array(sorted(set(_split(text))), pa.string())


def _item_parts(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of an item, of its question and of its answer, the last quarter; all of it for each if it is short."""
    words, whole = _split(text), np.unique(_shingles(text))
    answer = max(SHINGLE_WORDS, round(len(words) * ANSWER_PART))
    if len(words) < answer + SHINGLE_WORDS:
        return whole, whole, whole
    cut = len(words) - answer
    return whole, np.unique(_shingles(" ".join(words[:cut]))), np.unique(_shingles(" ".join(words[cut:])))


def _passage_hits(hashes: np.ndarray, firsts: np.ndarray, index: Index) -> dict[tuple[int, int], float]:
    """Best score of each pair of text and item that a passage brings to ``index.least``.

    A passage is two halves next to each other.  Bounds fall from step to step: the best a
    term can do anywhere, the best it can do in a block of items, and its weight.
    """
    at, term = index.known(hashes)
    doc = np.searchsorted(firsts, at, "right") - 1
    halves = -(-np.diff(firsts) // index.half)
    before = np.concatenate([[0], np.cumsum(halves)])
    every_half, every_term = before[doc] + (at - firsts[doc]) // index.half, term
    telling = index.telling[term]
    key = _distinct(every_half[telling] * len(index.terms) + term[telling], int(before[-1]) * len(index.terms))
    half, term = key // len(index.terms), key % len(index.terms)
    n = int(before[-1])
    same = np.zeros(n, bool)  # whether the next half is of the same text
    owner = np.repeat(np.arange(len(halves)), halves)
    same[:-1] = owner[1:] == owner[:-1]

    def joined(sums: np.ndarray) -> np.ndarray:
        both = sums.copy()
        both[:-1][same[:-1]] += sums[1:][same[:-1]]
        return both

    passages = np.flatnonzero(joined(np.bincount(half, index.most[term], n)) >= index.least - index.slack)
    starts, all_starts = (np.searchsorted(h, np.arange(n + 2)) for h in (half, every_half))
    found: dict[tuple[int, int], float] = {}
    some = max(1, SUMS // max(1, index.n_blocks))
    for k in range(0, len(passages), some):
        part = passages[k : k + some]
        rows, own = _terms_of(part, part + 1 + same[part], starts, term, len(index.terms))
        which, block, most = index.blocks.expanded(own)
        bound = np.bincount(rows[which] * index.n_blocks + block, most, len(part) * index.n_blocks)
        open_ = bound >= index.least - index.slack - 1e-9
        if not open_.any():
            continue
        live = np.unique(np.flatnonzero(open_) // index.n_blocks)
        rows, own = _terms_of(part[live], part[live] + 1 + same[part[live]], all_starts, every_term, len(index.terms))
        rows = live[rows]
        which, item, weight = index.items.expanded(own)
        keep = open_[rows[which] * index.n_blocks + item // BLOCK_ITEMS]
        pairs, inverse = np.unique(rows[which][keep] * len(index.ids) + item[keep], return_inverse=True)
        score = np.bincount(inverse, weight[keep], len(pairs))
        for pair, s in zip(pairs[score >= index.least].tolist(), score[score >= index.least].tolist()):
            place = (int(owner[part[pair // len(index.ids)]]), pair % len(index.ids))
            found[place] = max(s, found.get(place, 0.0))
    return found


def _distinct(keys: np.ndarray, below: int) -> np.ndarray:
    """The distinct keys in order; marked in a table where that is small, which is faster."""
    if below > MARKS:
        return np.unique(keys)
    seen = np.zeros(below, bool)
    seen[keys] = True
    return np.flatnonzero(seen)


def _terms_of(first: np.ndarray, last: np.ndarray, starts: np.ndarray, term: np.ndarray, terms: int):
    """Rows and distinct terms of passages that go from one half up to another."""
    counts = starts[last] - starts[first]
    key = _distinct(np.repeat(np.arange(len(first)), counts) * terms + term[ranges(starts[first], counts)], len(first) * terms)
    return key // terms, key % terms


def _hits(column, index: Index) -> list[list[dict]]:
    hits: list[list[dict]] = [[] for _ in range(len(column))]
    if not len(index.terms):
        return hits
    hashes, firsts = token_hashes(column)
    held: dict[int, np.ndarray] = {}
    last = -1
    for (doc, item), score in sorted(_passage_hits(hashes, firsts, index).items()):
        if doc != last:
            held, last = {}, doc
        # An item of fewer than five words is one shingle of its own length.
        length = index.shingle_words[item]
        if length not in held:
            held[length] = np.unique(_shingles(column[doc].as_py(), length))
        overlaps = [float(np.isin(part, held[length]).mean()) if len(part) else 0.0 for part in index.parts[item]]
        if overlaps[0] >= LEAST_OVERLAP:
            hits[doc].append({"item_id": int(index.ids[item]), "score": score, **dict(zip(OVERLAPS, overlaps))})
    return hits


HIT_TYPE = T.ArrayType(
    T.StructType([T.StructField("item_id", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in ("score", *OVERLAPS))])
)
HIT_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), *((n, pa.float64()) for n in ("score", *OVERLAPS))]))


def with_hits(docs: DataFrame, items: DataFrame, name: str = "benchmark_hits") -> DataFrame:
    """``docs`` with a last column ``name``: the items found in the whole text, with BM25 score and overlaps.

    ``items`` has ``item_id`` and ``text``; those with a null id or no word are never found.
    Passages of every text are queries to the index; where one has at least half the
    item's own score, 0.8 of the distinct five-word shingles of the whole item must be
    in the document; an item of fewer words must be there as a whole.  The half is lowered for all items if a copy of one could score less.
    Overlaps of question and answer are told, but decide nothing.  Null and empty texts have no hits; repeated rows are kept; other
    columns are kept, but one called ``name`` is replaced.
    """
    rows = docs.drop(name).withColumn("text", F.col("text").cast("string")).withColumn(name, F.array().cast(HIT_TYPE))
    for held in _indexes(items):
        rows = _one_index(rows, held)
    return rows


def _terms_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct term of each item once, and its tokens on the first of them."""
    for batch in slices(batches, "text"):
        hashes, firsts = token_hashes(batch.column("text"))
        item = np.repeat(np.arange(batch.num_rows), np.diff(firsts))
        pairs, first = np.unique(np.stack([item.astype(np.uint64), hashes]), axis=1, return_index=True)
        tokens = np.where(np.isin(first, firsts), np.diff(firsts)[pairs[0].astype(np.int64)], 0)
        shard = batch.column("shard").take(pa.array(pairs[0].astype(np.int64)))
        columns = [shard, pa.array(pairs[1].view(np.int64)), pa.array(tokens.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "term", "tokens"])


def _indexes(items: DataFrame) -> Iterator:
    """Indexes of all items, each of about ``INDEX_BYTES`` of text, sent to the executors.

    Terms are weighed by all items, however many indexes these make.
    """
    spark = items.sparkSession
    items = items.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    items = items.where(F.regexp_replace("text", "[ \\t-\\r]+", "") != "")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // INDEX_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)))
    if shards > 1:
        terms = stored(items.select("shard", "text").mapInArrow(_terms_of_items, "shard bigint, term bigint, tokens bigint"))
        n, tokens = items.count(), terms.agg(F.sum("tokens")).first()[0]
        counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        counts = stored(terms.select("shard", "term").distinct().join(counts, "term"))
    for shard in range(shards):
        own, among = items.where(F.col("shard") == shard).orderBy("item_id", "text").toPandas(), None
        if shards > 1:
            found = counts.where(F.col("shard") == shard).toPandas()
            among = Among(n, tokens / n, found["term"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64))
        yield spark.sparkContext.broadcast(Index(own["item_id"].tolist(), own["text"].tolist(), among))


def _one_index(rows: DataFrame, held) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            new = _hits(batch.column("text"), held.value)
            old = batch.column(batch.num_columns - 1).to_pylist()
            joined = pa.array([a + b for a, b in zip(old, new)], HIT_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], joined], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and item found in it: ``doc_id``, ``item_id``, ``score``, ``overlap``, ``question``, ``answer``."""
    rows = with_hits(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), items, "hits")
    return rows.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows in which an item is found."""
    for held in _indexes(items):
        docs = docs.where(_without_hits(held)(F.col("text").cast("string")))
    return docs


def _without_hits(held):
    def clean(text: pa.Array) -> pa.Array:
        # Only the texts go to Python, and one answer a row comes back.
        return pa.array([not hits for part in pieces(text) for hits in _hits(part, held.value)], pa.bool_())

    return F.arrow_udf(clean, "boolean")
