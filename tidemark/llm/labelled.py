"""Bounded samples of labelled rows for the classifiers.

A sample is the ``most`` eligible (doc_id, label) pairs with the smallest hash
of doc_id: the same pairs on every run, spread evenly over the table. Only pairs
are sampled and joined back to the texts, so the texts of other rows never move.

Defined results: a pair on several rows is one pair; a doc_id on rows of several
texts gives the one of the smallest hash, a null text only where it has no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(labels: DataFrame, label: str, most: int, where: Column | None = None) -> DataFrame:
    """At most ``most`` (doc_id, label) pairs; rows without id or label are no candidates."""
    rows = labels.select(F.col("doc_id").cast("long").alias("_id"),
                         F.col(label).cast("int").alias("_label"))
    rows = rows.where("_id IS NOT NULL AND _label IS NOT NULL")
    if where is not None:
        rows = rows.where(where)
    return rows.distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(most)


def with_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(_id, _label, text), one row per chosen pair with a document: at most
    ``most`` pairs of 12 bytes each are broadcast."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    first = F.struct(F.col("text").isNull(), F.xxhash64("text"))
    return (texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label")
            .agg(F.min_by("text", first).alias("text")))
