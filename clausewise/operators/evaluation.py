"""Classification metrics from one small table of (label, prediction) counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise.functions import values as v


def pair_counts(df: DataFrame, label: str = "label", predicted: str = "predicted_label") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("string").alias("label"), F.col(predicted).cast("string").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def class_counts(pairs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Per class: hits, rows with that label, rows predicted so."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("label"), hit.alias("hits"), F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("predicted").alias("label"), zero.alias("hits"), zero.alias("support"), F.col("n").alias("predicted")),
    )
    rows = pairs.select(F.explode(sides).alias("s")).select("s.*")
    if labels is not None:
        none = [zero.alias(name) for name in ("hits", "support", "predicted")]
        rows = rows.unionByName(labels.select("label", *none))
    return rows.groupBy("label").agg(*[F.sum(name).alias(name) for name in ("hits", "support", "predicted")])


def class_scores(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
            "f1": _ratio(2.0 * F.col("hits"), F.col("support") + F.col("predicted")),
        }
    )


def _steady_sum(c: Column) -> Column:
    """Sum of scores that does not depend on the order of the classes."""
    return F.sum(c.cast("decimal(30,12)")).cast("double")


def eval_metrics(df: DataFrame, label: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """Accuracy, macro F1 and weighted F1 in one row; 0 without rows."""
    scores = class_scores(class_counts(pair_counts(df, label, predicted)))
    total, one = F.sum("support"), F.count(F.lit(1))
    return scores.agg(
        F.coalesce(v.rounded(_ratio(F.sum("hits"), total), 6), F.lit(0.0)).alias("accuracy"),
        F.coalesce(v.rounded(_ratio(_steady_sum(F.col("f1")), one), 6), F.lit(0.0)).alias("macro_f1"),
        F.coalesce(v.rounded(_ratio(_steady_sum(F.col("f1") * F.col("support")), total), 6), F.lit(0.0)).alias(
            "weighted_f1"
        ),
    )


def eval_multilabel(
    df: DataFrame, labels: str = "labels", logits: str = "logits", threshold: float = 0.5
) -> DataFrame:
    """Exact-match accuracy, macro and weighted F1 of several yes/no labels per row.

    Rows fold into counts per label in one pass; position -1 carries the row
    totals for the accuracy.
    """
    yes = F.transform(logits, lambda x: (1.0 / (1.0 + F.exp(-x)) >= threshold).cast("int"))
    truth = F.transform(labels, lambda x: x.cast("int"))
    pairs = F.arrays_zip(truth.alias("truth"), yes.alias("guess"))
    whole = F.struct(F.lit(1).alias("truth"), (truth == yes).cast("int").alias("guess"))
    flat = df.select(
        F.posexplode(F.concat(F.array(whole), F.transform(pairs, lambda p: F.struct(p["truth"].alias("truth"), p["guess"].alias("guess"))))).alias("pos", "p")
    )
    counts = flat.groupBy("pos").agg(
        F.sum(F.col("p.truth") * F.col("p.guess")).alias("hits"),
        F.sum("p.truth").alias("support"),
        F.sum("p.guess").alias("predicted"),
    )
    scores = class_scores(counts)
    per_label = F.col("pos") > 0
    f1 = F.when(per_label, F.col("f1"))
    support = F.when(per_label, F.col("support"))
    return scores.agg(
        v.rounded(F.coalesce(F.max(F.when(~per_label, F.col("recall"))), F.lit(0.0)), 6).alias("accuracy"),
        v.rounded(_ratio(F.coalesce(_steady_sum(f1), F.lit(0.0)), F.count(f1)), 6).alias("macro_f1"),
        v.rounded(
            F.coalesce(_ratio(_steady_sum(f1 * support), F.sum(support)), F.lit(0.0)), 6
        ).alias("weighted_f1"),
    )


def eval_report(
    df: DataFrame, labels: DataFrame | None = None, label: str = "label", predicted: str = "predicted_label"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    scores = class_scores(class_counts(pair_counts(df, label, predicted), labels))
    names, one, total = ("precision", "recall", "f1"), F.count(F.lit(1)), F.sum("support")
    averages = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"),
                _ratio(F.sum("hits"), total).alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"),
                *[(_steady_sum(F.col(x)) / one).alias(x) for x in names],
                total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[_ratio(_steady_sum(F.col(x) * F.col("support")), total).alias(x) for x in names],
                total.alias("support"),
            ),
        ).alias("a")
    )
    rows = scores.select("label", *names, "support").unionByName(
        averages.select(F.explode("a").alias("r")).select("r.*")
    )
    return rows.select("label", *[v.rounded(F.col(x), 6).alias(x) for x in names], "support")


def eval_confusion(
    df: DataFrame, labels: Sequence[str], label: str = "label", predicted: str = "predicted_label"
) -> DataFrame:
    """Confusion matrix over the given labels, in their order."""
    pairs = pair_counts(df, label, predicted)
    counts = pairs.groupBy("label").agg(
        *[F.sum(F.when(F.col("predicted") == name, F.col("n")).otherwise(0)).alias(name) for name in labels]
    )
    rows = df.sparkSession.createDataFrame([(i, name) for i, name in enumerate(labels)], "label_id bigint, label string")
    return rows.join(counts, "label", "left").na.fill(0, list(labels)).select("label_id", "label", *labels).orderBy("label_id")
