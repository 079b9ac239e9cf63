"""Toxicity by gradient-boosted trees with isotonic calibration (operator 1).

The labelled sample is dealt into folds of a half, three tenths and a fifth by a hash of the id. From the first a lexicon is
learned: words and word beginnings that stand in toxic texts much more often than in others. On the second,
trees are fitted over dense features of whole texts: lexicon densities, nearness to words in the second
person, rates of capitals, punctuation and obfuscated words. The third calibrates their output.

Every row gets a score. A null or empty text has the features of an empty text. If a fold lacks one of
the two labels, all rows score the share of toxic rows in the sample. Repeated rows stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from clausewise.llm.common import small_batches, table
from clausewise.llm.samples import SAMPLE_ROWS, labelled, remainder
from clausewise.session import materialise

#: Lengths of word beginnings that may be entries of the lexicon.
BEGINNINGS = (3, 4, 5, 6, 7)
LEXICON_ROWS = 3_000
MIN_LOG_ODDS, STRONG = 1.5, 3.5
NEAR = 5
THRESHOLD = 0.7
#: Weight of the trees' own probability, which orders rows that the calibration makes equal.
TIE = 0.001
#: Second person in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tuyo usted ustedes vosotros".split()
)
WORDS = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][*@$#0-9][^\W\d_]")
SHOUTED = re.compile(r"\b[A-ZÀ-Þ]{3,}\b")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
FEATURES = [
    "strong_share", "weak_share", "mean_odds", "top_odds", "third_odds", "log_strong", "near_person", "person_share",
    "capital_rate", "shouted_share", "exclamations", "questions", "punctuation", "obfuscated", "stretched", "digits", "log_words",
]


class Odds(dict):
    """Largest log odds of a word and its beginnings; words not seen before are worked out once."""

    KEPT = 300_000

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        get = self.lexicon.get
        value = max(get(word, 0.0), *(get(word[:n] + "-", 0.0) for n in BEGINNINGS if len(word) > n), 0.0)
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = value
        return value


def features(text: str, odds: Odds) -> list[float]:
    words = WORDS.findall(text.lower())
    n, chars = max(1, len(words)), max(1, len(text))
    values = [odds[w] for w in words]
    hits = sorted((v for v in values if v >= MIN_LOG_ODDS), reverse=True)
    strong = [i for i, v in enumerate(values) if v >= STRONG]
    near = sum(any(w in SECOND_PERSON for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in strong)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(data, minlength=256) if len(data) else np.zeros(256, int)
    return [
        len(strong) / n, len(hits) / n, sum(hits) / n, hits[0] if hits else 0.0, hits[2] if len(hits) > 2 else 0.0,
        math.log1p(len(strong)), near / n, sum(map(SECOND_PERSON.__contains__, words)) / n,
        float(kinds[65:91].sum()) / chars, len(SHOUTED.findall(text)) / n, float(kinds[33]) / n, float(kinds[63]) / n,
        float(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()) / chars,
        len(OBFUSCATED.findall(text)) / n, len(STRETCHED.findall(text)) / n, float(kinds[48:58].sum()) / chars,
        math.log1p(len(words)),
    ]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Entry (a word, or a beginning with a hyphen) to log odds, from (text, label); at most LEXICON_ROWS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            entries, marks = [], []
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                words = set(WORDS.findall(text.lower()))
                own = words | {w[:n] + "-" for w in words for n in BEGINNINGS if len(w) > n}
                entries += own
                marks += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(marks, pa.int32())], ["entry", "label"])

    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}
    found = sample.select("text", "label").mapInArrow(run, "entry string, label int").groupBy("entry")
    counts = found.agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("all"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("all") - F.col("bad") + 0.5) / (good + 1))
    least = max(3, bad // 200)
    kept = counts.where(F.col("bad") >= least).withColumn("odds", odds).where(F.col("odds") >= MIN_LOG_ODDS)
    rows = kept.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "entry").limit(LEXICON_ROWS).collect()
    return {r["entry"]: r["odds"] for r in rows}


def with_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The kept columns of docs and ``_dense``, an array in the order of FEATURES."""
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)
    rest = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    schema = StructType([*rest.schema.fields[:-1], StructField("_dense", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = Odds(shipped.value)
        for batch in small_batches(batches):
            dense = [features(x, odds) for x in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(dense, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_dense"])

    return rest.mapInArrow(run, schema)


class Model:
    """Fitted lexicon, trees and calibration; columns of its own begin with an underscore."""

    def __init__(self, docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> None:
        sample = labelled(docs, labels, "toxic", remainder("doc_id", 3) != 1, rows)
        share = sample.groupBy("fold").agg(F.avg("label").alias("p"), F.count(F.lit(1)).alias("n")).collect()
        total = sum(r["n"] for r in share)
        self.constant = sum(r["p"] * r["n"] for r in share) / total if total else 0.0
        self.trees = None
        self.lexicon = learn_lexicon(sample.where("fold = 0"))
        if len(share) < 3 or any(r["p"] in (0.0, 1.0) for r in share):
            return
        made = materialise(with_features(sample, self.lexicon, ["label", "fold"]))
        made = made.withColumn("_features", array_to_vector("_dense"))
        classifier = GBTClassifier(
            labelCol="label", featuresCol="_features", predictionCol="_prediction", maxIter=20, maxDepth=3, stepSize=0.2,
            seed=7, maxBins=48,
        )
        trees = classifier.fit(made.where("fold = 1").coalesce(1))  # a part of a bounded sample
        self.trees = trees.setRawPredictionCol("_raw").setProbabilityCol("_probability")
        isotonic = IsotonicRegression(labelCol="label", featuresCol="_p", predictionCol="_calibrated")
        self.calibration = isotonic.fit(self._chance(made.where("fold = 2").coalesce(1)))

    def _chance(self, made: DataFrame) -> DataFrame:
        out = self.trees.transform(made)
        return out.withColumn("_p", F.element_at(vector_to_array("_probability"), 2))

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and score for every row."""
        if self.trees is None:
            return docs.select(*keep, F.lit(float(self.constant)).alias("score"))
        made = with_features(docs, self.lexicon, keep).withColumn("_features", array_to_vector("_dense"))
        calibrated = self.calibration.transform(self._chance(made))
        score = (1 - TIE) * F.least(F.greatest("_calibrated", F.lit(0.0)), F.lit(1.0)) + TIE * F.col("_p")
        return calibrated.select(*keep, score.alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = Model(docs, table(spark, sf_dir, "labels")).score(docs, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
