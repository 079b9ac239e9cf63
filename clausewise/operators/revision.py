"""Revision need, its priority, and the report per standard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v


def with_need(
    df: DataFrame,
    text: Column,
    matched: Column,
    status: Column,
    revision_rules: Sequence[Mapping] = tuple(rules.REVISION_RULES),
) -> DataFrame:
    """Add revision_need, revision_need_type and bare_reason, by the first rule that holds."""
    df = df.withColumns({"_text": text, "_matched": matched, "_status": F.coalesce(status, F.lit(""))})

    def holds(test: Mapping) -> Column:
        parts = []
        if "all" in test:
            parts.append(v.contains_all(F.col("_text"), test["all"]))
        if "any" in test:
            parts.append(v.contains_any(F.col("_text"), test["any"]))
        if "status" in test:
            parts.append(F.col("_status").isin(list(test["status"])))
        return reduce(Column.__and__, parts)

    # The number of the outcome first: the texts are searched once, for it alone.
    outcomes = [
        {**rules.REVISION_UNMATCHED, "needed": False},
        *revision_rules,
        {**rules.REVISION_OTHERWISE, "needed": False},
    ]
    number = F.when(~F.col("_matched"), 0)
    for i, rule in enumerate(revision_rules, start=1):
        number = number.when(reduce(Column.__or__, map(holds, rule["tests"])), i)
    df = df.withColumn("_outcome", number.otherwise(len(outcomes) - 1))

    def pick(part: str) -> Column:
        return F.get(F.array(*[F.lit(outcome[part]) for outcome in outcomes]), F.col("_outcome"))

    return df.withColumns(
        {
            "revision_need": pick("needed"),
            "revision_need_type": pick("need"),
            "bare_reason": F.replace(pick("reason"), F.lit("{status}"), F.col("_status")),
        }
    ).drop("_text", "_matched", "_status", "_outcome")


def label_of(score: Column, thresholds: Mapping[str, float]) -> Column:
    return (
        F.when(score >= thresholds["high"], "高").when(score >= thresholds["medium"], "中").otherwise("低")
    )


def revision_priority(
    df: DataFrame,
    need: Column,
    match_score: Column,
    status: Column | None = None,
    priority_rules: Mapping = rules.REVISION_PRIORITY_RULES,
) -> Column:
    """Priority in 0..1; standards on their way out lift needed revisions to a floor."""
    w = priority_rules["weights"]
    label = v.first_filled(df, ["priority_label"])
    given = F.coalesce(v.number_in(df, "priority_score"), F.lit(0.0))
    by_label = v.mapped(label, priority_rules["label_scores"], priority_rules["label_default"])
    level = v.first_filled(df, rules.LINK_ALIASES["level"])
    score = (
        w["issue"] * F.when(given > 0, given).otherwise(by_label)
        + w["need"] * F.when(need, 1.0).otherwise(0.0)
        + w["match"] * match_score
        + w["level"] * v.mapped(level, priority_rules["level_scores"], priority_rules["level_default"])
    )
    score = v.rounded(F.least(F.lit(1.0), score), 4)
    if status is None:
        return score
    lagging = need & F.coalesce(status.isin(rules.LAGGING_STATUSES), F.lit(False))
    return F.when(lagging, F.greatest(score, F.lit(priority_rules["lagging_floor"]))).otherwise(score)


def with_revision(
    df: DataFrame,
    matched: Column,
    status: Column,
    evidence: Column,
    match_score: Column,
    revision_rules: Sequence[Mapping] = tuple(rules.REVISION_RULES),
) -> DataFrame:
    """Add the five revision columns of issues that come with their best match."""
    columns = df.columns
    df = v.with_filled(df, rules.REVISION_TEXT_FIELDS, prefix="_f_")
    df = df.select(*columns, v.joined_of(df, rules.REVISION_TEXT_FIELDS, prefix="_f_").alias("_whole"))
    text = F.col("_whole")
    shown = F.when(matched, F.coalesce(evidence, F.lit(""))).otherwise("")
    df = with_need(df, text, matched, status, revision_rules).withColumns(
        {
            "revision_priority_score": revision_priority(df, F.col("revision_need"), match_score, status),
            "_shown": F.substring(shown, 1, rules.EVIDENCE_CHARS),
        }
    )
    reason = F.concat(
        F.col("bare_reason"),
        F.when(F.col("_shown") != "", F.concat(F.lit(rules.REVISION_EVIDENCE), F.col("_shown"))).otherwise(""),
    )
    cuts = rules.REVISION_PRIORITY_RULES["label_thresholds"]
    return df.withColumns(
        {"revision_priority_label": label_of(F.col("revision_priority_score"), cuts), "revision_reason": reason}
    ).drop("bare_reason", "_shown", "_whole")


def relation_of(matched: Column, need: Column, status: Column) -> Column:
    """How an issue relates to its standard."""
    lagging = F.coalesce(status.isin(rules.LAGGING_STATUSES), F.lit(False))
    other = F.when(lagging, "standard_lagging").otherwise("manual_review")
    out = other
    for name, relation in reversed(rules.RELATION_OF_NEED.items()):
        hit = (need == name) & ~lagging if name == "执行落实问题" else need == name
        out = F.when(hit, relation).otherwise(out)
    return F.when(matched, out).otherwise("unmatched")


def standard_report(
    enriched: DataFrame,
    order_by: Sequence[str],
    id_fields: Sequence[str] = ("sample_id", "issue_id"),
) -> DataFrame:
    """Counts, means, score, label and examples per standard reference, best first."""
    numbers = {
        name: F.coalesce(v.number_in(enriched, name), F.lit(0.0))
        for name in ("priority_score", "revision_priority_score", "kg_match_score")
    }
    rows = enriched.select(
        F.explode(v.split_refs(v.first_filled(enriched, ["kg_standard_refs"]), v.REPORT_REF_BREAK)).alias("standard_ref"),
        v.first_filled(enriched, id_fields).alias("example_id"),
        (v.is_flag(F.col("revision_need")) if "revision_need" in enriched.columns else F.lit(False)).alias("need"),
        v.first_filled(enriched, rules.LINK_ALIASES["level"]).isin(rules.MAJOR_LEVELS).alias("major"),
        *[number.alias(name) for name, number in numbers.items()],
        *[F.col(name).alias(f"order_{i}") for i, name in enumerate(order_by)],
    )
    n = F.count(F.lit(1))
    totals = rows.groupBy("standard_ref").agg(
        n.alias("linked_issue_count"),
        F.count_if("need").alias("revision_need_count"),
        F.count_if("major").alias("major_or_above_issue_count"),
        F.max("priority_score").alias("max_issue"),
        (v.total(F.col("priority_score")) / n).alias("avg_issue"),
        (v.total(F.col("kg_match_score")) / n).alias("avg_match"),
        F.max("revision_priority_score").alias("max_revision"),
    )
    order_columns = [f"order_{i}" for i in range(len(order_by))]
    telling = Window.partitionBy("standard_ref").orderBy(F.desc("revision_priority_score"), *order_columns)
    examples = (
        rows.withColumn("n", F.row_number().over(telling))
        .filter(F.col("n") <= rules.REPORT_EXAMPLES)
        .groupBy("standard_ref")
        .agg(F.sort_array(F.collect_list(F.struct("n", "example_id"))).alias("e"))
        .select("standard_ref", F.concat_ws("；", F.col("e.example_id")).alias("example_issue_ids"))
    )
    w, count = rules.REPORT_WEIGHTS, F.col("linked_issue_count")
    mixed = (
        w["count"] * F.least(count / float(rules.REPORT_FULL_COUNT), F.lit(1.0))
        + w["need"] * (F.col("revision_need_count") / count)
        + w["max_priority"] * F.col("max_issue")
        + w["avg_priority"] * F.col("avg_issue")
        + w["major"] * (F.col("major_or_above_issue_count") / count)
        + w["match"] * F.col("avg_match")
    )
    score = v.rounded(F.greatest(mixed, rules.REPORT_REVISION_SHARE * F.col("max_revision")), 4)
    return (
        totals.join(examples, "standard_ref")
        .select(
            "standard_ref",
            "linked_issue_count",
            "revision_need_count",
            "major_or_above_issue_count",
            v.rounded(F.col("max_issue"), 4).alias("max_issue_priority"),
            v.rounded(F.col("avg_issue"), 4).alias("avg_issue_priority"),
            v.rounded(F.col("avg_match"), 4).alias("avg_kg_match_score"),
            score.alias("standard_revision_priority_score"),
            label_of(score, rules.REVISION_PRIORITY_RULES["label_thresholds"]).alias(
                "standard_revision_priority_label"
            ),
            "example_issue_ids",
        )
        .orderBy(F.desc("standard_revision_priority_score"), F.desc("linked_issue_count"), "standard_ref")
    )


def link_report(enriched: DataFrame, order_by: Sequence[str], top: int = 10, samples: int = 5) -> DataFrame:
    """Long table (section, item, rows, score) of a linking run.

    One pass counts totals, statuses and needs; the top standards and the best
    samples are limited sorts.
    """
    status = v.text_of(F.col("kg_match_status"))
    need = v.text_of(F.col("revision_need_type"))
    entry = lambda section, item: F.struct(F.lit(section).alias("section"), item.alias("item"))
    flagged = v.is_flag(F.col("revision_need"))
    counted = (
        enriched.select(
            F.explode(
                F.filter(
                    F.array(
                        entry("total", F.lit("")),
                        F.when(status == "matched", entry("matched", F.lit(""))),
                        F.when(flagged, entry("revision_need", F.lit(""))),
                        entry("status", status),
                        entry("need_type", need),
                    ),
                    lambda x: x.isNotNull(),
                )
            ).alias("e")
        )
        .groupBy("e.section", "e.item")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # The match rate is the matched share of all rows, from the same pass.
    rate = (
        counted.filter("section IN ('total', 'matched')")
        .agg(
            F.sum(F.when(F.col("section") == "matched", F.col("rows")).otherwise(0)).alias("hit"),
            F.sum(F.when(F.col("section") == "total", F.col("rows")).otherwise(0)).alias("all"),
        )
        .select(
            F.lit("match_rate").alias("section"),
            F.lit("").alias("item"),
            F.lit(None).cast("bigint").alias("rows"),
            F.when(F.col("all") > 0, v.rounded(F.col("hit") / F.col("all"), 4)).otherwise(0.0).alias("score"),
        )
    )
    standards = standard_report(enriched, order_by).limit(top).select(
        F.lit("top_standard").alias("section"),
        F.col("standard_ref").alias("item"),
        F.col("linked_issue_count").alias("rows"),
        F.col("standard_revision_priority_score").alias("score"),
    )
    best = (
        enriched.filter(status == "matched")
        .select(
            F.lit("best_sample").alias("section"),
            v.first_filled(enriched, ["sample_id"]).alias("item"),
            F.lit(None).cast("bigint").alias("rows"),
            F.col("kg_match_score").alias("score"),
            *[F.col(name).alias(f"order_{i}") for i, name in enumerate(order_by)],
        )
        .orderBy(F.desc("score"), *[f"order_{i}" for i in range(len(order_by))])
        .limit(samples)
        .select("section", "item", "rows", "score")
    )
    plain = counted.withColumn("score", F.lit(None).cast("double"))
    return plain.unionByName(rate).unionByName(standards).unionByName(best)
