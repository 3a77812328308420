"""Labelled texts for the classifiers: a bounded, seeded sample on the driver, and the folds of the contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled(labels: DataFrame, label: str, keep: Column) -> DataFrame:
    """(doc_id, y) of the rows that `keep` selects. Labels other than 0 and 1 don't count; of several of one document the largest does."""
    return labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & keep).groupBy("doc_id").agg(F.max(label).alias("y"))


def seeded(label: str) -> Column:
    """An order of the ids that does not depend on partitions."""
    return F.xxhash64(F.lit(f"sample-{label}"), "doc_id")


def first_ids(ids: DataFrame, label: str, most_rows: int) -> DataFrame:
    return ids.orderBy(seeded(label), "doc_id").limit(most_rows)


def chosen_texts(docs: DataFrame, ids: DataFrame, most_bytes: int) -> DataFrame:
    """(doc_id, y, text) of these few ids, texts of at most `most_bytes` bytes; of several texts of one id the first in order."""
    texts = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes)
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.max("y").cast("int").alias("y"), F.min(F.coalesce("text", F.lit(""))).alias("text"))


def texts_of(docs: DataFrame, ids: DataFrame, most_bytes: int) -> tuple[list[str], list[int]]:
    """Texts and labels of chosen_texts(), in the order of the ids."""
    rows = chosen_texts(docs, ids, most_bytes).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["y"] for r in rows]


def sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most_rows: int, most_bytes: int) -> tuple[list[str], list[int]]:
    """At most `most_rows` labelled texts of at most `most_bytes` bytes, in a seeded order that does not depend on partitions.

    `keep` selects the rows to learn from, by `doc_id`. Labels other than 0 and 1 don't count; of several labels of one
    document the largest does. Only ids and labels are ordered; texts are fetched for the chosen ids alone.
    """
    return texts_of(docs, first_ids(labelled(labels, label, keep), label, most_rows), most_bytes)
