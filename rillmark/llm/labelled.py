"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_of(column: str) -> Column:
    """crc32 of a value as text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most ``per_class`` documents of each label, and the number of labelled rows of each.

    The choice is by hash of the id, so it is the same for every layout. Of several rows
    with one id, or several documents with one text, one stays. Only ids are ranked; at
    most ``2 * per_class`` ids are broadcast.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(usable & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    found = found.groupBy(F.xxhash64("text").alias("same")).agg(F.min_by(F.struct("doc_id", "text", "y"), "doc_id").alias("d"))
    return found.select("d.*"), counts
