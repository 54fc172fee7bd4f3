"""Quality of documents: logistic regression on hashed word n-grams, trained by FTRL updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import U64, mixed, slices, sums_by, token_hashes
from landfall.llm.samples import labelled_sample
from landfall.llm.tables import held_out, share_of_hash

FEATURE_BITS = 18
# Bound of the sample that is learned from, and the parts of it that are learned apart and averaged.
SAMPLE_ROWS = 12_000
SHARDS = 8
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
THRESHOLD = 0.3


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words and of pairs of words next to each other, text by text, and where each text starts."""
    hashes, firsts = token_hashes(column)
    n = len(hashes)
    numbers = np.zeros(2 * n, np.int64)
    shift = U64(64 - FEATURE_BITS)
    numbers[::2] = hashes >> shift
    if n:
        pairs = mixed(hashes[:-1] * U64(3) + hashes[1:])
        # A word said twice is one feature, whatever the word.
        pairs[hashes[:-1] == hashes[1:]] = 0
        numbers[1:-1:2] = pairs >> shift
        # The last word of a text has no partner: it counts twice.
        last = firsts[1:][firsts[1:] > firsts[:-1]] - 1
        numbers[2 * last + 1] = numbers[2 * last]
    return numbers, 2 * firsts


class Ftrl:
    """Follow-the-regularised-leader logistic regression over sparse rows, with a bias as last weight."""

    def __init__(self):
        self.z = np.zeros((1 << FEATURE_BITS) + 1)
        self.n = np.zeros((1 << FEATURE_BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def sparse_row(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = np.unique(numbers, return_counts=True)
    return np.append(at, 1 << FEATURE_BITS), np.append(counts / np.sqrt(max(1, len(numbers))), 1.0)


def _fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "doc_id"])
    numbers, firsts = features(pa.array(rows["text"], pa.string()))
    sparse = [sparse_row(numbers[a:b]) for a, b in zip(firsts[:-1], firsts[1:])]
    model = Ftrl()
    for _ in range(EPOCHS):
        for (at, x), y in zip(sparse, rows["y"]):
            model.learn(at, x, y)
    w = model.weights()
    at = np.flatnonzero(w)
    return pd.DataFrame({"at": at, "w": w[at]})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from a sample of at most about ``max_rows`` labelled documents.

    The sample is dealt to a fixed number of shards, each learned from in the order of a
    hash, and the weights are averaged; their number is fixed, so they fit the driver.
    """
    sample = labelled_sample(docs, labels, label, max_rows).withColumn("order", share_of_hash(F.col("doc_id"), 11))
    sample = sample.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(SHARDS)))
    parts = sample.groupBy("shard").applyInPandas(_fit_shard, "at bigint, w double")
    means = parts.groupBy("at").agg((F.sum("w") / SHARDS).alias("w")).toPandas()
    weights = np.zeros((1 << FEATURE_BITS) + 1)
    weights[means["at"]] = means["w"]
    return weights


def scores(column, weights: np.ndarray) -> np.ndarray:
    numbers, firsts = features(column)
    size = np.maximum(1, np.diff(firsts))
    margin = sums_by(weights[numbers], firsts) / np.sqrt(size) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.3 on) for every row.

    A score is a sparse dot product over the whole text.  Null and empty texts get the
    score of the bias; a null doc_id is scored, never learned from; repeated rows give
    repeated rows; without labels all scores are 0.5.  Other columns do not matter.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, "quality", max_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = pa.array(scores(batch.column("text"), held.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
