"""Folds and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of doc_id as text, mod `mod`; a null doc_id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % mod).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, column: str, limit: int, mod: int = 0, held: int = -1) -> DataFrame:
    """doc_id, text (null: empty), label and key, a hash of the text, of at most `limit` labelled documents, those first by a hash of doc_id; of them, the rows outside the held-out fold.

    A document with several label rows takes the largest label. Null ids and null labels take no part. The chosen
    labels (two numbers each, at most `limit`) are broadcast; the documents are not moved.
    """
    known = labels.select(F.col("doc_id").alias("__id"), (F.col(column) == 1).cast("int").alias("__y")).where("__id is not null and __y is not null")
    if mod:
        known = known.where(fold("__id", mod) != held)
    chosen = known.groupBy("__id").agg(F.max("__y").alias("__y")).orderBy(F.xxhash64(F.lit(7), "__id"), "__id").limit(limit)
    rows = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text")).join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    text = F.coalesce(F.col("__text"), F.lit(""))
    return rows.select(F.col("__doc").alias("doc_id"), text.alias("text"), F.col("__y").alias("label"), F.xxhash64(F.lit(11), text).alias("key"))


def bounded(rows: DataFrame, limit: int) -> list[Row]:
    """(key, x, label) of at most `limit` rows of key, x, label: equal keys once, with their largest label; those first by key, in this order.

    key: a hash of the text, from which x follows. So the sample depends neither on files and partitions nor on which copy comes first.
    """
    return rows.groupBy("key").agg(F.any_value("x").alias("x"), F.max("label").alias("label")).orderBy("key").limit(limit).collect()
