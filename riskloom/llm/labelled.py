"""Labelled rows for the classifiers: folds, and a bounded sample of training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id is in fold 0."""
    text = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(text.cast("string").cast("binary")) % folds, F.lit(0))


def sample(
    labels: DataFrame, label: str, training: Column, most: int, *, per_class: bool = False
) -> DataFrame:
    """At most ``most`` labelled ids, drawn by their hash: ``doc_id, label``.

    Repeated labels of an id count with their mean. ``per_class`` draws half of the rows
    from each class (mean of 0.5 or more, or less).
    """
    known = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("double").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(training)
    known = known.groupBy("doc_id").agg(F.avg("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if not per_class:
        return known.orderBy(*order).limit(most)
    upper = known.where("label >= 0.5").orderBy(*order).limit(most // 2)
    return upper.union(known.where("label < 0.5").orderBy(*order).limit(most // 2))


def with_texts(chosen: DataFrame, documents: DataFrame) -> DataFrame:
    """``doc_id, label, text`` of a bounded sample of labels; one row, the least text, per id."""
    texts = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    met = texts.join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
