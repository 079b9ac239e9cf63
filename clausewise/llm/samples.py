"""Labelled rows for fitting, all of them or a bounded sample; every fitted model then scores all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise.session import materialise

#: Labelled rows that a model is fitted on at most: those with the least hash of their doc_id.
SAMPLE_ROWS = 15_000


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo a number."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def known(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """(doc_id, label) of all rows that may be learned from; a repeated label is 1 if any is."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    return rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label, fold) of the sample, written once."""
    chosen = known(labels, label, allowed).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(10))
    fold = F.when(place < 5, 0).when(place < 8, 1).otherwise(2)  # a half, three tenths, a fifth
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most ``rows`` ids, so a broadcast has a bound of a few hundred KB
    return materialise(texts.join(F.broadcast(chosen), "doc_id").withColumn("fold", fold))
