"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.session import materialise

#: Rows that a task turns into Python objects at once.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task holds stays bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


#: A key with more than this share of all rows is hot; there are fewer such keys than that.
HOT_KEYS = 10_000


def lookup(left: DataFrame, right: DataFrame, key: str, rows: int, keep: bool = False) -> DataFrame:
    """left with the columns of right, in which ``key`` is unique and ``_uses`` says how many rows of left it has.

    ``rows`` is the number of rows of left. Keys with more than one in HOT_KEYS of them are fewer than HOT_KEYS, so
    those are broadcast; the others are shuffled, and none of them is hot. Rows without a match are
    dropped, or kept with nulls if ``keep`` is set.
    """
    is_hot = F.col("_uses") * HOT_KEYS > rows
    hot, cold = right.where(is_hot).drop("_uses"), right.where(~is_hot).drop("_uses")
    found = left.join(F.broadcast(hot), key)
    others = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return found.unionByName(others.join(cold, key, "left" if keep else "inner"))


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: (id, component), component being the smallest id reachable.

    vertices has id; edges has a and b, in any direction, repeated or not. Ids are
    compared as Spark orders them and are not null. Each round every vertex takes the
    smallest label among its own and its neighbours' and then the label of that label, so
    long chains shrink by more than one step a round. A round is one table in the
    shared folder; the driver sees only how many labels changed. Vertices without edges
    keep their own id and take no part in the rounds.
    """
    both = materialise(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    )
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
    labels = materialise(labels.select("id", F.least("id", "low").alias("component")))
    while True:
        seen = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
        near = labels.join(seen.agg(F.min("component").alias("seen")), "id").select(
            "id", F.col("component").alias("old"), F.least("component", "seen").alias("low")
        )
        parent = near.select(F.col("id").alias("low"), F.col("low").alias("above"))
        new = materialise(
            near.join(parent, "low").select(
                "id", F.least("low", "above").alias("component"), (F.least("low", "above") < F.col("old")).alias("moved")
            )
        )
        labels = new.select("id", "component")
        if new.where("moved").limit(1).count() == 0:
            break
    return vertices.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
