"""Stratified train/valid/test splits with exact sizes, saved with a manifest."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.session import materialise

BUCKET_DIGITS = 3


def _shared_out(sizes: DataFrame, size: str, wanted: Column, out: str) -> DataFrame:
    """Share out a number of rows over the strata in proportion to their sizes.

    Everyone gets the whole part of their share, the largest remainders one more.
    ``sizes`` has one row per label.
    """
    everyone = Window.partitionBy()
    share = F.col(size) * wanted / F.sum(size).over(everyone)
    sizes = sizes.withColumn("_wanted", wanted).withColumn("_share", share)
    sizes = sizes.withColumn("_base", F.floor("_share"))
    left = F.col("_wanted") - F.sum("_base").over(everyone)
    place = F.row_number().over(Window.orderBy(F.desc(F.col("_share") - F.col("_base")), "stratum"))
    extra = F.when(place <= left, 1).otherwise(0)
    return sizes.withColumn(out, (F.col("_base") + extra).cast("bigint")).drop("_wanted", "_share", "_base")


def _can_stratify(rows: DataFrame) -> bool:
    """At least two labels, each with at least two rows."""
    count = F.count(F.lit(1))
    labels = rows.groupBy("stratum").agg(count.alias("n")).agg(count.alias("k"), F.min("n").alias("low")).first()
    return labels["k"] >= 2 and labels["low"] >= 2


def _taken(marked: DataFrame, share: float, id_col: str) -> DataFrame:
    """Rows with ``_taken``: the first ones of each stratum in the order of their marks, in all the floor of ``share``.

    No stratum is ever sorted as a whole: rows are ranked inside (stratum, first hash digits) and shifted by the
    counts of the earlier buckets, which hash evenly.
    """
    buckets = marked.groupBy("stratum", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("stratum", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    sizes = buckets.groupBy("stratum").agg(F.sum("n").alias("n"))
    whole = F.sum("n").over(Window.partitionBy())
    sizes = _shared_out(sizes, "n", F.floor(share * whole), "_size").select("stratum", "_size")
    inside = F.row_number().over(Window.partitionBy("stratum", "_bucket").orderBy("_mark", id_col))
    placed = marked.withColumn("_inside", inside).join(starts, ["stratum", "_bucket"]).join(sizes, "stratum")
    taken = (F.col("_start") + F.col("_inside") <= F.col("_size")).alias("_taken")
    return placed.select(*marked.columns, taken)


def split_stratified(
    df: DataFrame,
    label_field: str,
    id_col: str,
    *,
    train: float = 0.8,
    valid: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
    stratify: bool = True,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Rows with their ``split``.

    Rows are ordered at random by the hash of seed and id. First train is taken, then valid from what is left.
    Either step keeps the shares of the labels if it can, that is if each of two labels or more has
    two rows there; otherwise it takes from all rows alike. Only ids and labels take part, what the first
    step leaves is written once, and wide rows are joined at the end.
    """
    if round(train + valid + test, 6) != 1.0:
        raise ValueError("train + valid + test must be 1")
    mark = F.sha1(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    thin = df.select(id_col, label_field)
    labelled = thin.withColumns({"stratum": F.coalesce(F.col(label_field).cast("string"), F.lit("")), "_mark": mark})
    marked = labelled.withColumn("_bucket", F.substring("_mark", 1, digits))
    plain = lambda rows: rows.withColumn("stratum", F.lit(""))
    by_label = lambda rows: rows if stratify and _can_stratify(rows) else plain(rows)
    first = materialise(_taken(by_label(marked), train, id_col))
    rest = first.where(~F.col("_taken")).drop("_taken").withColumn("stratum", F.coalesce(F.col(label_field).cast("string"), F.lit("")))
    second = _taken(by_label(rest), valid / (valid + test), id_col) if valid + test else rest.withColumn("_taken", F.lit(False))
    name = F.when(F.col("_taken"), "valid").otherwise("test").alias("split")
    placed = first.where("_taken").select(*thin.columns, F.lit("train").alias("split")).unionByName(second.select(*thin.columns, name))
    if set(df.columns) == set(thin.columns):
        return placed
    return df.join(placed.select(id_col, "split"), id_col)


def given_splits(frames: Mapping[str, DataFrame], path: str, id_col: str) -> Mapping[str, DataFrame]:
    """Splits that are given as tables of their own, saved as one table with a manifest.

    They must have the same columns and no id in common (a null id is none); otherwise nothing is written.
    ``saved_splits`` and this function write the same form, so either can be read by what follows.
    """
    names = sorted(frames)
    columns = {n: sorted(frames[n].columns) for n in names}
    if len({tuple(c) for c in columns.values()}) != 1:
        raise ValueError(f"splits differ in their columns: {columns}")
    parts = [frames[n].select(*frames[names[0]].columns).withColumn("split", F.lit(n)) for n in names]
    rows = reduce(DataFrame.unionByName, parts)
    both = rows.where(F.col(f"`{id_col}`").isNotNull()).groupBy(id_col).agg(F.min("split").alias("a"), F.max("split").alias("b"))
    twice = both.where("a <> b").limit(5).collect()
    if twice:
        raise ValueError("ids in two splits: " + ", ".join(f"{r[id_col]} ({r['a']}, {r['b']})" for r in twice))
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    manifest = json.dumps({"given": {n: digest(frames[n]) for n in names}}, sort_keys=True)
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return read_splits(spark, path, names)


def read_splits(spark: SparkSession, path: str, names: Sequence[str] = ("train", "valid", "test")) -> Mapping[str, DataFrame]:
    """The splits of a saved table; a filter on the partition column reads only the files of one."""
    rows = spark.read.parquet(f"{path}/rows")
    return {name: rows.filter(F.col("split") == name).drop("split") for name in names}


def digest(df: DataFrame) -> str:
    """Order-free fingerprint of a table: row count and sum of row hashes."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h")).first()
    return f"{found['n']}:{found['h']}"


def saved_splits(
    spark: SparkSession, df: DataFrame, path: str, label_field: str, id_col: str, **options: object
) -> Mapping[str, DataFrame]:
    """Saved splits of a table, made anew when the table or the options changed."""
    manifest = json.dumps({"source": digest(df), "label": label_field, **options}, sort_keys=True)
    try:
        same = spark.read.text(f"{path}/manifest").first()["value"] == manifest
    except AnalysisException:
        same = False
    if not same:
        rows = split_stratified(df, label_field, id_col, **options)
        rows.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/manifest"
        )
    return read_splits(spark, path)
