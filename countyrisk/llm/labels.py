"""Bounded samples of labelled texts for fitting, and the rows that are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that no model learns from: CRC-32 of the id as text, modulo 4, is 2."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, per_class: int) -> list[tuple[str, int]]:
    """At most ``per_class`` (text, label) pairs of either class, in the order of a hash of the id.

    The sample of labels has 2 x ``per_class`` rows at most, which bounds what is broadcast to
    the scan of the texts. Of the texts of one id the smallest by hash comes back, once for each
    label of the id."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    one = lambda label: usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    chosen = one(0).unionByName(one(1)).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    rows = met.select("doc_id", "least.text", "label").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    return list(zip(rows.column("text").to_pylist(), rows.column("label").to_pylist(), strict=True))
