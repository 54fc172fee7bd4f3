"""Toxic passages of documents: maximum-scoring segments of token log-odds, with extreme-value calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import U64, mixed, slices, token_hashes
from landfall.llm.samples import labelled_sample
from landfall.llm.tables import held_out

# Bound of the sample that is learned from, and of the tokens that are told apart.
SAMPLE_ROWS = 20_000
LEXICON = 50_000
# Weight of the Dirichlet prior in tokens, and how sure a token has to be toxic.
PRIOR = 4.0
LEAST_Z = 4.0
LEAST_ODDS = 2.0
# A longer token that is not told apart itself is read by its first bytes.
STEM_BYTES = 8
# A passage ends when so many tokens say nothing after one that counts as toxic.
PASSAGE_TOKENS = 64
THRESHOLD = 0.5


@dataclass
class Model:
    """Token scores in order of their hashes, what any other token scores, and the calibration."""

    hashes: np.ndarray
    scores: np.ndarray
    rest: float
    rate: float  # the lambda of the extreme-value law
    scale: float  # its K
    bias: float
    slope: float


def segments(at: list[int], score: list[float], rest: float, length: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text, in linear time.

    Tokens ``at`` have a positive ``score``, all others score ``rest`` < 0.  Only stretches from
    one positive token to another can be maximal, so the scan goes over these.  Each
    candidate keeps the running sum before it and after it; one that starts lower than
    the new one and ends below it is joined with all that lies between.
    """
    found: list[list] = []  # start, end, sum before, sum after
    sums, last = 0.0, 0
    for k, s in zip(at, score):
        sums += rest * (k - last)
        new = [k, k + 1, sums, sums + s]
        sums, last = sums + s, k + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(s, e, after - before) for s, e, before, after, _ in found]


def _positive(column, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and scores of the tokens that count, and where the tokens of each text start."""
    hashes, stems, firsts = token_hashes(column, STEM_BYTES)
    if not len(model.hashes):
        return np.zeros(0, np.int64), np.zeros(0), firsts
    value = np.zeros(len(hashes))
    for keys in (stem_keys(stems), hashes):
        place = np.minimum(np.searchsorted(model.hashes, keys), len(model.hashes) - 1)
        known = model.hashes[place] == keys
        value[known] = model.scores[place[known]]
    at = np.flatnonzero(value)
    return at, value[at], firsts


def stem_keys(stems: np.ndarray) -> np.ndarray:
    """Keys for the stems of longer tokens, apart from those of whole tokens; zero for none."""
    return np.where(stems == 0, U64(0), mixed(stems + U64(1)))


def passages(column, model: Model) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """For each text its number of tokens and its maximal segments."""
    at, score, firsts = _positive(column, model)
    cuts = np.searchsorted(at, firsts)
    for k in range(len(firsts) - 1):
        a, b, length = cuts[k], cuts[k + 1], int(firsts[k + 1] - firsts[k])
        own = (at[a:b] - firsts[k]).tolist()
        yield length, segments(own, score[a:b].tolist(), model.rest, length) if own else []


def surprise(length: int, found: list[tuple[int, int, float]], model: Model) -> float:
    """How far the significant segments together exceed what chance brings, on a logarithmic scale."""
    above = sum(max(0.0, model.rate * s - by_chance(length, model)) for _, _, s in found)
    return float(np.log1p(above))


def by_chance(length: int, model: Model) -> float:
    """What a segment, times the rate of the law, has to exceed in a text of that length to count as significant."""
    return float(np.log(max(model.scale * length, 1.0)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashes, stems, firsts = token_hashes(batch.column("text"), STEM_BYTES)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(firsts))
        longer = stems != 0
        hashes, doc = np.append(hashes, stem_keys(stems[longer])), np.append(doc, doc[longer])
        values, which = np.unique(hashes, return_inverse=True)
        # A text counts once for each of its tokens: what one text says again and again proves little.
        once = np.unique(doc * max(1, len(values)) + which)
        toxic = batch.column("y").to_numpy(zero_copy_only=False)[once // max(1, len(values))] == 1
        which = once % max(1, len(values))
        columns = [np.bincount(which[toxic == t], minlength=len(values)) for t in (True, False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), *map(pa.array, columns)], ["token", "toxic", "clean"]
        )


def background_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive number at which the mean of exp(rate * score) is one."""
    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        over = float(shares @ np.exp(np.minimum(mid * scores, 500))) > 1
        low, high = (low, mid) if over else (mid, high)
    return low


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic regression of one variable, lightly regularised."""
    a, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        a -= np.clip(np.linalg.solve(hessian, design.T @ (p - y) + 1e-3 * a), -5, 5)
    return float(a[0]), float(a[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = SAMPLE_ROWS) -> Model:
    """The model of a sample of at most about ``max_rows`` labelled documents.

    Log-odds of a token in toxic against other texts have a Dirichlet prior of ``PRIOR``
    tokens, shared out as the classes are.  Tokens are counted on the executors; only
    those sure to be toxic, at most ``LEXICON``, come to the driver.
    """
    sample = labelled_sample(docs, labels, label, max_rows)
    counts = (
        sample.mapInArrow(_count, "token bigint, toxic bigint, clean bigint")
        .groupBy("token")
        .agg(F.sum("toxic").cast("double").alias("t"), F.sum("clean").cast("double").alias("c"))
    )
    sums = counts.agg(F.coalesce(F.sum("t"), F.lit(0.0)), F.coalesce(F.sum("c"), F.lit(0.0))).first()
    toxic, clean = sums
    share = (toxic + 1) / (toxic + clean + 2)
    t, c = F.col("t") + PRIOR * share, F.col("c") + PRIOR * (1 - share)
    odds = F.log(t / c) - float(np.log(share / (1 - share)))
    known = (
        counts.select("token", "c", odds.alias("score"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
        .where((F.col("z") >= LEAST_Z) & (F.col("score") >= LEAST_ODDS))
        .orderBy(F.desc("z"), "token")
        .limit(LEXICON)
        .toPandas()
    )
    known["hash"] = known["token"].to_numpy(np.int64).view(np.uint64)
    known = known.sort_values("hash")
    scores = known["score"].to_numpy(np.float64)
    rest = -float(scores.mean()) / PASSAGE_TOKENS if len(scores) else -0.1
    shares = known["c"].to_numpy(np.float64) / max(clean, 1.0)
    rate = background_rate(np.append(scores, rest), np.append(shares, max(0.0, 1 - shares.sum())))
    model = Model(known["hash"].to_numpy(), scores, rest, rate, 1.0, 0.0, 0.0)
    return _calibrated(sample, model)


def _calibrated(sample: DataFrame, model: Model) -> Model:
    """``model`` with the scale of its law from clean texts and the bias and slope of its scores; the sample is bounded."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [(n, max((s for *_, s in found), default=0.0), [s for *_, s in found]) for n, found in passages(batch.column("text"), model)]
            lengths, most, parts = (list(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array(lengths, pa.int64()), pa.array(most, pa.float64()), pa.array(parts, pa.list_(pa.float64()))],
                ["y", "n", "best", "parts"],
            )

    rows = sample.select("y", "text").mapInArrow(best, "y int, n bigint, best double, parts array<double>").toPandas()
    clean = rows[rows["y"] == 0]
    cut = float(model.scores.min()) if len(model.scores) else 1.0
    expected = float(clean["n"].sum()) * np.exp(-model.rate * cut)
    model.scale = max(1e-6, float(clean["parts"].map(len).sum() + 0.5) / max(expected, 1e-9))
    x = np.array([surprise(n, [(0, 0, s) for s in parts], model) for n, parts in zip(rows["n"], rows["parts"])])
    if len(rows):
        model.bias, model.slope = logistic(x, rows["y"].to_numpy(np.float64))
    return model


def toxic_scores(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` and ``passages`` for every row.

    ``passages`` lists the significant segments of the whole text by token position.  Null
    and empty texts have none and get the score of the bias; a null doc_id is scored,
    never learned from; repeated rows give repeated rows; without labels all scores
    are 0.5.  Other columns do not matter.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, "toxic", max_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in slices(batches, "text"):
            margins, lists = [], []
            for length, found in passages(batch.column("text"), model):
                margins.append(model.bias + model.slope * surprise(length, found, model))
                chance = by_chance(length, model)
                lists.append([{"first": s, "end": e, "score": v} for s, e, v in found if model.rate * v > chance])
            values = 1 / (1 + np.exp(-np.clip(np.array(margins), -500, 500)))
            spans = pa.array(lists, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values), spans], ["doc_id", "score", "passages"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id bigint, score double, passages array<struct<first: bigint, end: bigint, score: double>>"
    return rows.mapInArrow(score, kinds).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )
