"""Bounded samples of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.tables import learnable, share_of_hash


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """``doc_id``, ``text`` and ``y`` (0 or 1) of about ``max_rows`` labelled documents at most.

    Only rows to learn from are taken, chosen by a hash of the doc_id.  Of several
    labels of a document the largest counts; null labels do not.  As the sample of the
    labels is bounded by ``max_rows``, it is broadcast, and texts are not shuffled.
    """
    known = (
        labels.where(learnable(F.col("doc_id")) & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.max(label).cast("int").alias("y"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where(share_of_hash(F.col("_labelled")) < share)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled")).select("doc_id", "text", "y")
