"""Labels, a one-label text classifier, its predictions, and feature vectors.

The classifier is multinomial naive Bayes on character bigrams. Its model is a table: a row per gram with a whole-number
log weight per class (millionths), so fitting is a grouped count, applying it an equi-join and a sum per
text, and results depend neither on the order of rows nor on retried tasks. ``train_regression`` and
``predict_regression`` are the same task with Spark ML's logistic regression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.session import materialise

VECTOR_DIM = 768
FEATURES = 1 << 14


def label_map(df: DataFrame, label_field: str = "label") -> DataFrame:
    """Sorted distinct labels with ids from 0; one row per class."""
    labels = df.select(F.col(label_field).cast("string").alias("label")).distinct()
    number = F.row_number().over(Window.orderBy("label"))
    return labels.select("label", (number - 1).cast("bigint").alias("label_id"))


def encode_labels(df: DataFrame, labels: DataFrame, label_field: str = "label") -> DataFrame:
    """Label text and number per row, other nulls as ''; an unknown label fails the job."""
    texts = [
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns if c != label_field
    ]
    plain = df.select(*texts, F.col(label_field).cast("string").alias("label_text"))
    known = labels.select(F.col("label").alias("label_text"), F.col("label_id").alias("labels"))
    unknown = F.raise_error(F.concat(F.lit("label outside the mapping: "), F.coalesce("label_text", F.lit("null"))))
    joined = plain.join(known, "label_text", "left")
    return joined.withColumn("labels", F.coalesce("labels", unknown.cast("bigint")))


def with_grams(df: DataFrame, text_field: str = "model_input") -> DataFrame:
    """Character bigrams of the whole text, as the classifier reads them."""
    text = t.cleaned(F.col(text_field))
    every = F.regexp_extract_all(text, F.lit("(?=(..))"), F.lit(1))
    return df.withColumn("grams", F.when(F.length(text) <= 2, F.array(text)).otherwise(every))


#: Weights are logarithms in millionths.
UNIT = 1_000_000


@dataclass(frozen=True)
class Bayes:
    """``weights`` has gram and weights (one per class), ``priors`` one row with priors (one per class)."""

    weights: DataFrame
    priors: DataFrame
    classes: int


def train_classifier(df: DataFrame, classes: int, text_field: str = "model_input", label_id: str = "labels") -> Bayes:
    """Fit on all rows; ``label_id`` runs from 0 to ``classes`` - 1. Counts are smoothed by one.

    Tasks count before the shuffle, so a frequent gram or class is a few rows of it.
    """
    ids, c = range(classes), F.col
    each = with_grams(df, text_field).select(c(label_id).alias("k"), F.explode("grams").alias("gram"))
    seen = each.groupBy("gram").agg(*[F.count_if(c("k") == k).alias(f"n{k}") for k in ids])
    seen = materialise(seen)
    totals = seen.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"n{k}").alias(f"t{k}") for k in ids])
    log = lambda x: F.round(F.ln(x) * UNIT).cast("bigint")
    total = [totals.select(F.coalesce(c(f"t{k}"), F.lit(0)) + c("v")).scalar() for k in ids]
    weights = seen.select("gram", F.array(*[log((c(f"n{k}") + 1) / total[k]) for k in ids]).alias("weights"))
    rows = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c(label_id) == k).alias(f"n{k}") for k in ids])
    # a class without rows gets the prior of one row, so that all have one
    priors = rows.select(F.array(*[log(F.greatest(c(f"n{k}"), F.lit(1)) / F.greatest(c("n"), F.lit(1))) for k in ids]).alias("priors"))
    return Bayes(materialise(weights), materialise(priors), classes)


def batch_predict(
    df: DataFrame, model: Bayes, labels: Sequence[str], id_col: str, text_field: str = "model_input"
) -> DataFrame:
    """(id, label id, label, confidence) of every row: the class with the largest sum, the first on a tie, and its
    probability. Grams that the model has not seen count for no class."""
    ids, c = range(model.classes), F.col
    each = with_grams(df, text_field).select(c(id_col).alias("_id"), F.explode("grams").alias("gram"))
    met = each.join(model.weights, "gram", "left")
    sums = met.groupBy("_id").agg(*[F.coalesce(F.sum(F.get("weights", F.lit(k))), F.lit(0)).alias(f"s{k}") for k in ids])
    prior = model.priors.select("priors").scalar()
    scores = sums.withColumn("scores", F.array(*[c(f"s{k}") + F.get(prior, F.lit(k)) for k in ids]))
    best = scores.withColumn("best", F.array_max("scores"))
    place = F.array_position("scores", c("best")) - 1
    mass = F.aggregate("scores", F.lit(0.0), lambda total, x: total + F.exp((x - c("best")) / UNIT))
    names = F.array(*[F.lit(name) for name in labels])
    return best.select(
        c("_id").alias(id_col),
        place.cast("bigint").alias("predicted_label_id"),
        F.get(names, place.cast("int")).alias("predicted_label"),
        v.rounded(1.0 / mass, 6).alias("confidence"),
    )


def train_regression(
    df: DataFrame,
    text_field: str = "model_input",
    label_id: str = "labels",
    *,
    features: int = FEATURES,
    max_iter: int = 20,
    reg: float = 0.01,
) -> PipelineModel:
    """Multinomial logistic regression on hashed bigram counts."""
    stages = [
        HashingTF(inputCol="grams", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(
            featuresCol="features", labelCol=label_id, family="multinomial", maxIter=max_iter, regParam=reg
        ),
    ]
    rows = with_grams(df, text_field).select("grams", F.col(label_id).cast("double").alias(label_id))
    return Pipeline(stages=stages).fit(rows)


def predict_regression(
    df: DataFrame, model: PipelineModel, labels: Sequence[str], text_field: str = "model_input"
) -> DataFrame:
    """Rows with label id, label and confidence (largest probability)."""
    done = model.transform(with_grams(df, text_field))
    names = F.array(*[F.lit(name) for name in labels])
    return done.select(
        *df.columns,
        F.col("prediction").cast("bigint").alias("predicted_label_id"),
        F.get(names, F.col("prediction").cast("int")).alias("predicted_label"),
        v.rounded(F.array_max(vector_to_array("probability")), 6).alias("confidence"),
    )


def feature_matrix(
    issues: DataFrame,
    vectors: DataFrame,
    id_col: str = "sample_id",
    *,
    vector_col: str = "vector",
    dim: int = VECTOR_DIM,
) -> DataFrame:
    """Issues with one vector each, widened to cls_0..cls_{dim-1}.

    An issue without a vector, or with one of another length, fails the job.
    """
    joined = issues.join(vectors.select(id_col, F.col(vector_col).alias("_vector")), id_col, "left")
    wrong = F.raise_error(
        F.concat(F.lit("unexpected vector size: "), F.coalesce(F.size("_vector").cast("string"), F.lit("none")))
    )
    checked = F.when(F.size("_vector") == dim, F.col("_vector")).otherwise(wrong.cast("array<float>"))
    joined = joined.withColumn("_vector", checked)
    wide = [F.element_at("_vector", i + 1).cast("float").alias(f"cls_{i}") for i in range(dim)]
    return joined.select(*issues.columns, *wide)


def feature_columns(df: DataFrame) -> DataFrame:
    """The eleven issue columns of the feature matrix."""
    renamed = {
        "sample_id": "sample_id",
        "problem_text": "text",
        "device_type": "device_type",
        "supervision_major": "specialty",
        "supervision_stage": "supervision_stage",
        "problem_phase": "problem_stage",
        "pred_level": "pred_level",
        "pred_category": "pred_category",
        "level_confidence": "level_confidence",
        "category_confidence": "category_confidence",
        "need_review": "need_review",
    }
    blank_null = {"device_type", "supervision_major", "supervision_stage", "problem_phase"}

    def column(out: str, source: str):
        if source not in df.columns:
            return (F.lit(False) if out == "need_review" else F.lit("")).alias(out)
        c = F.col(source)
        return (F.coalesce(c.cast("string"), F.lit("")) if out in blank_null else c).alias(out)

    return df.select(*[column(out, source) for out, source in renamed.items()])
