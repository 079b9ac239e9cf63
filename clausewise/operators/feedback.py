"""From predictions to review and back into training data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v
from clausewise.operators.cleaning import tagged


def attach_review(
    predictions: DataFrame,
    model_version: str,
    *,
    prediction_time: str | None = None,
    threshold: float = rules.REVIEW_THRESHOLD,
    status: str = "pending",
    comment: str = "",
    keep_model_input: bool = True,
    enabled: bool = True,
) -> DataFrame:
    """Predictions with the columns a reviewer fills in."""
    if not enabled:
        return predictions
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    unsure = F.coalesce(v.to_number(F.col("confidence")) < threshold, F.lit(False))
    out = predictions.withColumns(
        {
            "model_version": F.lit(model_version),
            "prediction_time": now if prediction_time is None else F.lit(prediction_time),
            "need_manual_review": unsure,
            "review_status": F.lit(status),
            "reviewed_label": F.lit(""),
            "review_comment": F.lit(comment),
            "feedback_time": F.lit(""),
            "final_label": F.col("predicted_label"),
        }
    )
    return out if keep_model_input else out.drop("model_input")


def last_per(df: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """Last row per key; every map task already keeps at most one row of a key."""
    back = [F.desc(c) if isinstance(c, str) else c.desc() for c in order_by]
    last = F.row_number().over(Window.partitionBy(key).orderBy(*back))
    return df.withColumn("_n", last).filter("_n = 1").drop("_n")


def accepted_labels(
    feedback: DataFrame,
    order_by: Sequence[str],
    *,
    key: str = "sample_id",
    label: str = "reviewed_label",
    status: str = "review_status",
    accepted: Sequence[str] = ("accepted", "corrected"),
) -> DataFrame:
    """(key, reviewed label): the last accepted one per key."""
    wanted = [word.lower() for word in accepted]
    chosen = feedback.filter(F.lower(F.col(status)).isin(wanted) & (v.text_of(F.col(label)) != ""))
    return last_per(chosen.select(key, label, *order_by), key, order_by).select(key, label)


def join_feedback(originals: DataFrame, labels: DataFrame, key: str = "sample_id") -> DataFrame:
    """Originals with their reviewed label, null where there is none."""
    return originals.drop("reviewed_label").join(labels, key, "left")


def retrain_dataset(
    originals: DataFrame,
    feedback: DataFrame,
    order_by: Sequence[str],
    *,
    label_field: str = "label",
    key: str = "sample_id",
    source_field: str = "data_source",
    **fields: object,
) -> DataFrame:
    """Originals with reviewed labels laid over them and reviewed rows tagged."""
    labels = accepted_labels(feedback, order_by, key=key, **fields)
    if labels.limit(1).count() == 0:
        if label_field in originals.columns:
            return originals
        return originals.filter(F.lit(False)).withColumn(label_field, F.lit(None).cast("string"))
    merged = join_feedback(originals, labels, key)
    reviewed = F.col("reviewed_label")
    if label_field in merged.columns:
        merged = merged.withColumn(label_field, F.coalesce(reviewed, F.col(label_field).cast("string")))
    else:
        merged = merged.withColumn(label_field, reviewed).filter(v.text_of(reviewed) != "")
    if source_field in merged.columns:
        source = F.col(source_field)
        tag = tagged(source.cast("string"), rules.REVIEWED_TAG)
        merged = merged.withColumn(source_field, F.when(reviewed.isNotNull(), tag).otherwise(source))
    else:
        merged = merged.withColumn(source_field, F.lit(rules.REVIEWED_TAG))
    return merged.drop("reviewed_label")


def append_feedback(
    base: DataFrame, samples: DataFrame, order_by: Sequence[str], key: str = "sample_id"
) -> DataFrame:
    """Both tables by column name; the last row per key wins, feedback after base."""
    both = base.withColumn("_part", F.lit(0)).unionByName(
        samples.withColumn("_part", F.lit(1)), allowMissingColumns=True
    )
    if key in both.columns:
        both = last_per(both, key, ["_part", *order_by])
    return both.drop("_part")
