"""Review queue, its subset of flagged rows, and the review summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v
from clausewise.session import materialise

NUMBERS = [
    "confidence", "level_confidence", "category_confidence", "priority_score", "kg_match_score",
    "revision_priority_score",
]


def review_rows(df: DataFrame) -> DataFrame:
    """The review columns that exist, in review order, with the five needed ones filled in."""

    def stand_in(names: list[str], kind: str) -> Column:
        found = next((name for name in names if name in df.columns), None)
        return F.col(found) if found else F.lit(None).cast(kind)

    defaults = {
        "predicted_label": F.coalesce(
            stand_in(["pred_level", "pred_category", "final_label", "label"], "string"), F.lit("")
        ),
        "confidence": stand_in(["level_confidence", "category_confidence", "kg_match_score"], "double"),
        "need_manual_review": stand_in(["need_review"], "boolean"),
        "review_status": F.lit("pending"),
        "reviewed_label": F.lit(""),
    }
    df = df.withColumns({name: c for name, c in defaults.items() if name not in df.columns})
    shaped = []
    for name in (c for c in rules.REVIEW_COLUMNS if c in df.columns):
        if name in ("need_review", "need_manual_review"):
            shaped.append(v.flag_of(df, name).alias(name))
        elif name in NUMBERS:
            shaped.append(v.number_of(df, name).alias(name))
        else:
            shaped.append(F.col(name))
    return df.select(*shaped)


def review_order(df: DataFrame) -> list[Column]:
    """Flagged first, then urgent, then unsure; nulls last; ties by id."""
    keys = [F.desc_nulls_last(c) for c in ("need_review", "need_manual_review", "priority_score") if c in df.columns]
    return [*keys, F.asc_nulls_last("confidence"), *(["sample_id"] if "sample_id" in df.columns else [])]


def review_queue(df: DataFrame) -> DataFrame:
    """All rows in review order; written first, since a sort reads its input for the ranges and for the rows."""
    rows = materialise(review_rows(df))
    return rows.orderBy(*review_order(rows))


def review_subset(df: DataFrame) -> DataFrame:
    """Flagged rows only, in queue order; filtered before they are sorted."""
    rows = review_rows(df)
    flag = "need_review" if "need_review" in rows.columns else "need_manual_review"
    rows = materialise(rows.filter(F.col(flag)))
    return rows.orderBy(*review_order(rows))


def display_columns(df: DataFrame) -> DataFrame:
    """Columns under their display names; columns that share a name are merged."""
    shown: dict[str, list[Column]] = {}
    for name in df.columns:
        shown.setdefault(rules.REVIEW_COLUMNS.get(name, name), []).append(F.col(name))
    return df.select(*[F.coalesce(*cs).alias(name) if len(cs) > 1 else cs[0].alias(name) for name, cs in shown.items()])


def review_summary(df: DataFrame) -> DataFrame:
    """Long table (item, value) under display names.

    Every row is turned into the items it counts for, and one grouping with
    partial counts adds them up, so the table is read once.
    """
    names = rules.SUMMARY_NAMES
    rows = review_rows(df)
    manual = F.col("need_manual_review")
    flag = F.col("need_review") if "need_review" in rows.columns else manual
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    when = lambda hit, item: F.when(hit, F.lit(names[item]))
    items = [
        F.lit(names["total_rows"]),
        when(manual, "need_manual_review_true"),
        when(~manual, "need_manual_review_false"),
        when(flag, "need_review_true"),
        when(text("review_status") == "pending", "review_status_pending"),
    ]
    always = ["total_rows", "need_manual_review_true", "need_manual_review_false", "need_review_true", "review_status_pending"]
    zeros = [names[item] for item in always]
    if "priority_label" in rows.columns:
        label = text("priority_label")
        items.append(F.when(label.isin(rules.PRIORITY_LABELS), F.concat(label, F.lit(names["priority_"]))))
        items.append(when((label == "高") & flag, "high_priority_and_need_review"))
        zeros += [x + names["priority_"] for x in rules.PRIORITY_LABELS] + [names["high_priority_and_need_review"]]
    if "revision_need" in rows.columns:
        items.append(when(v.is_flag(F.col("revision_need")), "revision_need_true"))
        zeros.append(names["revision_need_true"])
    grouped = {
        "revision": "revision_need_type" if "revision_need" in rows.columns else "",
        "kg_match": "kg_match_status",
        "category": "pred_category",
        "level": "pred_level",
    }
    for item, column in grouped.items():
        if column in rows.columns:
            items.append(F.when(text(column) != "", F.concat(F.lit(names[item]), text(column))))
    hits = rows.select(F.explode(F.array(*items)).alias("item")).filter("item IS NOT NULL")
    counted = hits.groupBy("item").agg(F.count(F.lit(1)).alias("value"))
    # Items without any row are listed too: one more row of zeros per fixed item.
    fixed = df.sparkSession.createDataFrame([(item, 0) for item in zeros], "item string, value bigint")
    return counted.unionByName(fixed).groupBy("item").agg(F.sum("value").alias("value"))


def top_priority(df: DataFrame, limit: int = 10) -> DataFrame:
    """The issues with the highest priority, ties by id."""
    shown = ["sample_id", "pred_level", "pred_category", "priority_score", "priority_label", "need_review", "text"]
    ties = ["sample_id"] if "sample_id" in df.columns else []
    top = df.orderBy(F.desc_nulls_last("priority_score"), *ties).limit(limit)
    return top.select(*[name for name in shown if name in df.columns])
