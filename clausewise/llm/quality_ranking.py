"""Quality by Bradley-Terry pairwise ranking (operator 4).

Each text has a utility: a sum of learned weights, one for the bin that each of its features falls into.
The chance that one document is preferred to another is the logistic function of the difference
of their utilities. Weights are fitted by logistic loss on feature differences of preference pairs, each a
good and a bad document. All labelled rows take part: bin edges are quantiles over them, pairs are made in hash buckets of
them, every Newton step is one pass over all pairs with sums per task, and the threshold is the quantile of all their
utilities that leaves their share of bad documents below; there the score is 0.3.

Every row gets a score. A null or empty text has the features of an empty text. Without both labels
all rows score the share of good rows (1 without any row). Repeated rows stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from clausewise.llm.common import small_batches, table
from clausewise.llm.samples import known, remainder
from clausewise.session import materialise

THRESHOLD = 0.3
#: Pairs of a document of the label that is more frequent in its bucket; the others have more.
PAIRS_EACH = 4
#: Documents of the rarer label that a bucket has at least, and documents of both, on average.
RARE_IN_BUCKET, IN_BUCKET = 50, 2_000
#: Ranks of a quantile over n rows are right within n divided by this.
ACCURACY = 10_000
BINS = 10
RIDGE = 1.0
SYMBOLS = b"#*$%&|<>"
SIGNS = re.compile(r"[#*$%&|<>]{2,}|!{2,}")
FEATURES = [
    "log_words", "word_length", "distinct_words", "top_word", "same_as_before", "distinct_pairs", "capitals", "symbols",
    "exclamations", "commas", "stops", "digits", "pipes", "sign_runs", "repeated_lines", "line_length", "short_lines",
    "capital_words", "other_letters",
]


def features(text: str) -> list[float]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    return [
        math.log1p(len(words)), size / n, len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words[1:], words)) / n, len(set(zip(words, words[1:]))) / n,
        float(kinds[65:91].sum()) / size, float(sum(kinds[b] for b in SYMBOLS)) / size, float(kinds[33]) / n,
        float(kinds[44]) / n, float(kinds[46]) / n, float(kinds[48:58].sum()) / size, float(kinds[124]) / n,
        len(SIGNS.findall(text)) / n, 1 - len(set(lines)) / m, math.log1p(size / m), sum(len(x) < 30 for x in lines) / m,
        sum(map(bytes.isupper, words)) / n, float(kinds[128:].sum()) / size,
    ]


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns with ``_dense``, the features of the text, unless that is there."""
    if "_dense" in docs.columns:
        return docs.select(*keep, "_dense")
    rest = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    schema = StructType([*rest.schema.fields[:-1], StructField("_dense", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            dense = [features(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(dense, pa.list_(pa.float64()))], schema.fieldNames())

    return rest.mapInArrow(run, schema)


def places(dense: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Column of each feature's bin, rows by features."""
    starts = np.cumsum([0, *(len(e) + 1 for e in edges)])
    return np.stack([starts[k] + np.searchsorted(e, dense[:, k], "right") for k, e in enumerate(edges)], axis=1)


def bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """Inner bin edges of each feature: the quantiles over all rows of either label."""
    shares = [k / BINS for k in range(1, BINS)]
    by_label = rows.groupBy("label").agg(
        *[F.percentile_approx(F.get("_dense", F.lit(k)), shares, ACCURACY).alias(f) for k, f in enumerate(FEATURES)]
    )
    found = by_label.collect()  # two rows
    return [np.unique([x for row in found for x in row[f]]) for f in FEATURES]


def with_cells(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """(doc_id, label, cells): the columns of each row's bins."""
    thin = rows.select("doc_id", "label", "_dense")
    schema = thin.select("doc_id", "label", F.array().cast("array<int>").alias("cells")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            dense = np.array(batch.column(2).to_pylist()).reshape(-1, len(FEATURES))
            cells = pa.array(list(places(dense, edges)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], cells], schema.fieldNames())

    return thin.mapInArrow(run, schema)


def preference_pairs(cells: DataFrame, ids: dict[int, int]) -> DataFrame:
    """(good, bad) cells of preference pairs in which every row takes part; ``ids`` has the number of ids by label.

    Rows are dealt over buckets by a hash of their id and numbered there. The i-th pairs of a bucket are its i-th good row and
    the PAIRS_EACH bad rows from the i-th on, both counted around, until either side is through. So pairs are as
    many as rows, up to a factor, and not goods times bads. A bucket without one of the labels would
    have no pairs; with RARE_IN_BUCKET expected that has a chance of e**-RARE_IN_BUCKET.
    """
    buckets = max(1, min(min(ids.values()) // RARE_IN_BUCKET, sum(ids.values()) // IN_BUCKET))
    bucket = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("bucket")), F.lit(buckets))
    order = Window.partitionBy("bucket", "label").orderBy(F.xxhash64(F.col("doc_id"), F.lit("pair")), "doc_id", "cells")
    dealt = cells.withColumn("bucket", bucket).withColumn("place", F.row_number().over(order) - 1)
    dealt = materialise(dealt.select("bucket", "label", "place", "cells"))
    sizes = dealt.groupBy("bucket").agg(F.count_if(F.col("label") == 1).alias("g"), F.count_if(F.col("label") == 0).alias("b"))
    turns = sizes.where("g > 0 and b > 0").select("bucket", "g", "b", F.expr("explode(sequence(0, greatest(g, b) - 1))").alias("i"))
    turns = turns.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(PAIRS_EACH - 1))))
    met = turns.select("bucket", F.expr("int(i % g)").alias("good_place"), F.expr("int((i + j) % b)").alias("bad_place"))
    side = lambda label, name: dealt.where(F.col("label") == label).select(
        "bucket", F.col("place").alias(f"{name}_place"), F.col("cells").alias(name)
    )
    pairs = met.join(side(1, "good"), ["bucket", "good_place"]).join(side(0, "bad"), ["bucket", "bad_place"])
    return materialise(pairs.select("good", "bad"))


def sums(pairs: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss over all pairs, without the ridge.

    A task adds up its pairs; a line of the matrix is then added over the tasks, in their order.
    """
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in small_batches(batches, 4096):
            good, bad = (c.flatten().to_numpy().reshape(-1, len(FEATURES)) for c in batch.columns)
            rows = np.arange(len(good))[:, None]
            difference = np.zeros((len(good), width), np.float32)
            difference[rows, good] += 1  # a row has one cell for each feature
            difference[rows, bad] -= 1
            p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
            total[:width] += difference.T @ (difference * (p * (1 - p)).astype(np.float32)[:, None])
            total[width] += difference.T @ (1 - p)
        lines = pa.array(np.arange(width + 1), pa.int32())
        part = pa.array(np.full(width + 1, TaskContext.get().partitionId()), pa.int32())
        yield pa.RecordBatch.from_arrays([lines, part, pa.array(list(total))], ["line", "part", "sums"])

    def add(lines: pa.Table) -> pa.Table:
        lines = lines.sort_by("part")
        added = np.sum(np.array(lines["sums"].to_pylist()), axis=0)
        return pa.table({"line": lines["line"][:1], "sums": pa.array([added])})

    by_task = pairs.mapInArrow(run, "line int, part int, sums array<double>")
    added = by_task.groupBy("line").applyInArrow(add, "line int, sums array<double>").collect()  # one row per weight
    lines = {row["line"]: row["sums"] for row in added}
    whole = np.array([lines.get(k, np.zeros(width)) for k in range(width + 1)])
    return whole[width], whole[:width]


def fit(rows: DataFrame, ids: dict[int, int]) -> dict:
    """Bin edges, weights and threshold from all rows (doc_id, label, _dense) of both labels."""
    edges = bin_edges(rows)
    pairs = preference_pairs(with_cells(rows, edges), ids)
    width = sum(len(e) + 1 for e in edges)
    weights = np.zeros(width)
    for _ in range(25):  # Newton steps on the logistic loss with a ridge
        gradient, curvature = sums(pairs, weights)
        step = np.linalg.solve(curvature + RIDGE * np.eye(width), gradient - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return {"edges": edges, "weights": weights}


def threshold_of(utilities: DataFrame) -> float:
    """Between the utility that the share of bad rows leaves at or below and the next one."""
    bad = utilities.agg(F.avg((F.col("label") == 0).cast("double"))).first()[0]
    low = utilities.agg(F.percentile_approx("_utility", bad, ACCURACY)).first()[0]
    high = utilities.where(F.col("_utility") > low).agg(F.min("_utility")).first()[0]
    return low if high is None else (low + high) / 2


class Model:
    """Weights fitted on all labelled rows; constant without both labels.

    Frames may come ``with_features``, so that their texts are not read again.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame) -> None:
        allowed = remainder("doc_id", 5) != 0
        made = with_features(docs.where(allowed), ["doc_id"])
        rows = materialise(made.join(known(labels, "quality", allowed), "doc_id"))
        counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).collect()
        n = sum(r["n"] for r in counted)
        self.constant = sum(r["n"] for r in counted if r["label"] == 1) / n if n else 1.0
        self.fitted = None
        if 0 < self.constant < 1:
            self.fitted = fit(rows, {r["label"]: r["ids"] for r in counted})
            self.fitted["threshold"] = threshold_of(materialise(self._utilities(rows, ["label"])))

    def _utilities(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns with ``_utility``, from those with ``_dense``."""
        shipped = rows.sparkSession.sparkContext.broadcast(self.fitted)
        thin = rows.select(*keep, "_dense")
        schema = StructType([*thin.schema.fields[:-1], StructField("_utility", DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fitted = shipped.value
            for batch in small_batches(batches):
                dense = np.array(batch.column(batch.num_columns - 1).to_pylist()).reshape(-1, len(FEATURES))
                values = fitted["weights"][places(dense, fitted["edges"])].sum(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.float64())], schema.fieldNames())

        return thin.mapInArrow(run, schema)

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and score for every row."""
        if self.fitted is None:
            return docs.select(*keep, F.lit(self.constant).alias("score"))
        made = self._utilities(with_features(docs, keep), keep)
        at_threshold = math.log(THRESHOLD / (1 - THRESHOLD))
        logit = F.col("_utility") - self.fitted["threshold"] + at_threshold
        return made.select(*keep, (1 / (1 + F.exp(-logit))).alias("score"))


def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = materialise(with_features(table(spark, sf_dir, "documents"), ["doc_id"]))
    scored = Model(docs, table(spark, sf_dir, "labels")).score(docs, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
