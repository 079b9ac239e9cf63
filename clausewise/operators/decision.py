"""The decision step: prediction roles, review flag, priority, advice, final label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v


def primary_role(target_name: str = "", label_field: str = "") -> str:
    """What a generic prediction stands for."""
    return "level" if "level" in f"{target_name} {label_field}".lower() else "category"


def role_columns(df: DataFrame, role: str) -> DataFrame:
    """Route a generic prediction to the columns of its role.

    Values that are already there win; confidences are numbers or null.
    """
    generic = next((name for name in ("predicted_label", "label") if name in df.columns), None)
    label = F.coalesce(F.col(generic).cast("string"), F.lit("")) if generic else F.lit("")
    confidence = v.number_in(df, "confidence")
    out = {}
    for name in ("level", "category"):
        pred, conf = f"pred_{name}", f"{name}_confidence"
        if pred not in df.columns:
            out[pred] = label if name == role else F.lit("")
        if conf not in df.columns:
            out[conf] = confidence if name == role else F.lit(None).cast("double")
        elif name == role:
            out[conf] = v.number_in(df, conf)
    return df.withColumns(out)


def attach_category(
    issues: DataFrame, predictions: DataFrame, id_col: str = "sample_id", complete: bool | None = None
) -> DataFrame:
    """Category label and confidence of a second model, by id.

    When every issue has a category already nothing changes, otherwise the
    whole pair of columns is replaced.  ``complete`` says which is the case and
    saves the check.
    """
    if complete is None:
        blank = v.text_of(F.col("pred_category")) == "" if "pred_category" in issues.columns else F.lit(True)
        complete = issues.filter(blank).limit(1).count() == 0
    if complete:
        return issues
    second = predictions.select(
        id_col,
        F.col("predicted_label").alias("pred_category"),
        v.number_in(predictions, "confidence").alias("category_confidence"),
        F.col("predicted_label_id").alias("category_label_id"),
    )
    return issues.drop("pred_category", "category_confidence", "category_label_id").join(second, id_col, "left")


def review_flag(df: DataFrame, threshold: float = rules.REVIEW_THRESHOLD) -> Column:
    """Flagged already, or one of both confidences below the threshold (missing counts as sure)."""
    flag = v.flag_of(df, "need_manual_review") if "need_manual_review" in df.columns else F.lit(False)
    for name in ("level_confidence", "category_confidence"):
        flag = flag | (F.coalesce(v.number_in(df, name), F.lit(1.0)) < threshold)
    return flag


def with_priority(df: DataFrame, priority_rules: Mapping = rules.PRIORITY_RULES) -> DataFrame:
    """Add score, label, reason and the five part scores of each issue."""
    w, repeats = priority_rules["weights"], priority_rules["repeat_thresholds"]
    levels = ["pred_level", "final_level", "issue_level", "predicted_label", "label"]
    categories = ["pred_category", "final_category", "issue_category"]
    columns = df.columns
    df = v.with_filled(df, [*levels, *categories, "device_type"], prefix="_f_")
    df = df.select(
        *columns,
        v.first_of(df, levels, rules.UNKNOWN, prefix="_f_").alias("_level"),
        v.first_of(df, categories, rules.UNKNOWN, prefix="_f_").alias("_category"),
        v.first_of(df, ["device_type"], rules.DEVICE_DEFAULT, prefix="_f_").alias("_device"),
    )
    level, category, device = F.col("_level"), F.col("_category"), F.col("_device")

    device_score = F.lit(float(priority_rules["device_default_score"]))
    for group in reversed(priority_rules["device_scores"]):
        hit = v.contains_any(device, group["keywords"])
        device_score = F.when(hit, float(group["score"])).otherwise(device_score)

    counted = "repeat_count" if "repeat_count" in df.columns else "historical_count"
    repeat = F.coalesce(v.number_in(df, counted), F.lit(0.0)).cast("bigint")
    repeat_score = (
        F.when(repeat >= repeats["high"], float(repeats["high_score"]))
        .when(repeat >= repeats["medium"], float(repeats["medium_score"]))
        .otherwise(float(repeats["default_score"]))
    )
    unsure = F.lit(float(priority_rules["confidence_default"]))
    sure = [F.coalesce(v.number_in(df, name), unsure) for name in ("level_confidence", "category_confidence")]
    level_scores, category_scores = priority_rules["level_scores"], priority_rules["category_scores"]
    parts = {
        "level_score": v.mapped(level, level_scores, level_scores[rules.UNKNOWN]),
        "device_score": device_score,
        "category_score": v.mapped(category, category_scores, category_scores[rules.UNKNOWN]),
        "repeat_score": repeat_score,
        "confidence_score": (sure[0] + sure[1]) / 2.0,
    }
    df = df.withColumns(parts)
    mixed = F.lit(0.0)
    for name in parts:
        mixed = mixed + float(w[name]) * F.col(name)
    df = df.withColumn("priority_score", v.rounded(mixed, 4))
    score, cuts = F.col("priority_score"), priority_rules["label_thresholds"]
    label = F.when(score >= cuts["high"], "高").when(score >= cuts["medium"], "中").otherwise("低")
    df = df.withColumn("priority_label", label)
    reason = F.concat(
        F.lit("问题等级为"), level, F.lit("，涉及设备为"), device, F.lit("，问题类别为"), category,
        F.lit("，综合历史重复情况和模型置信度后，建议按"), F.col("priority_label"), F.lit("优先级处理。"),
    )
    out = {"priority_reason": reason, "confidence_score": v.rounded(F.col("confidence_score"), 4)}
    return df.withColumns(out).drop("_level", "_category", "_device")


def with_advice(df: DataFrame, suggestion_rules: Mapping = rules.SUGGESTION_RULES) -> DataFrame:
    """Add suggestion, basis and action by category, from a literal map."""
    by_category = suggestion_rules["category_rules"]
    df = df.withColumn("_category", v.first_filled(df, ["pred_category", "issue_category"], rules.UNKNOWN))

    def advice(part: str) -> Column:
        pairs = [F.lit(x) for name, texts in by_category.items() for x in (name, texts[part])]
        other = F.lit(by_category[rules.UNKNOWN][part])
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col("_category")), other)

    flagged = F.lit(False)
    for name in ("need_review", "need_manual_review"):
        if name in df.columns:
            flagged = flagged | v.flag_of(df, name)
    label = v.first_filled(df, ["priority_label"])
    return df.withColumns(
        {
            "suggestion": advice("suggestion"),
            "suggestion_basis": advice("basis"),
            "recommended_action": F.concat_ws(
                " ",
                advice("action"),
                F.when(label == "高", suggestion_rules["high_priority_action"]),
                F.when(flagged, suggestion_rules["need_review_action"]),
            ),
        }
    ).drop("_category")


def decide(
    df: DataFrame,
    role: str = "level",
    *,
    threshold: float = rules.REVIEW_THRESHOLD,
    priority_rules: Mapping | None = None,
    suggestion_rules: Mapping | None = None,
) -> DataFrame:
    """The whole step; rule overrides are laid over the defaults, old outputs are replaced."""
    df = role_columns(df, role)
    df = df.withColumn("need_review", review_flag(df, threshold))
    df = with_priority(df, rules.merged(rules.PRIORITY_RULES, priority_rules))
    return with_advice(df, rules.merged(rules.SUGGESTION_RULES, suggestion_rules))


LABEL_FIELDS = ["review_status", "reviewed_label", "final_label", "label", "predicted_label"]


def confirmed_label_columns(df: DataFrame) -> dict[str, Column]:
    """Final label, where it comes from, and whether anyone reviewed it.

    The label fields must have gone through ``with_filled``.
    """
    status = F.lower(v.first_of(df, ["review_status"]))
    reviewed = v.first_of(df, ["reviewed_label"])
    by_hand = status.isin("accepted", "corrected") & (reviewed != "")
    return {
        "final_confirmed_label": F.when(by_hand, reviewed).otherwise(
            v.first_of(df, ["final_label", "label", "predicted_label"])
        ),
        "label_source": F.when(by_hand, "manual")
        .when(v.first_of(df, ["predicted_label"]) != "", "model")
        .when(v.first_of(df, ["label"]) != "", "dataset")
        .otherwise(""),
        "is_reviewed": ~status.isin("", "pending"),
    }
