"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.llm.common import held_out

#: Rows whose crc32(doc_id) modulo this is ``HELD_OUT_PART`` teach nothing.
FOLDS, HELD_OUT_PART = 3, 1


def one_label_each(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id`` and its label; of contradicting rows the larger, null ones are dropped."""
    return (
        labels.filter(F.col(label).isNotNull() & ~held_out("doc_id", FOLDS, HELD_OUT_PART))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )


def sampled(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of ``ids``, the first in the order of a digest of the id."""
    return ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most)


def with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sampled ids with their texts, one row an id. The sample's size is bounded."""
    others = [F.first(c).alias(c) for c in sample.columns if c != "doc_id"]
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), *others)
    )
