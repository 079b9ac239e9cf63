"""Ranking of standards and clauses by aggregated revision priority."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v
from clausewise.session import materialise

GROUP = ["kg_standard_id", "kg_standard_name", "kg_clause_id", "kg_clause_title"]
DIMENSIONS = ["device_type", "major", "organization", "region"]
COUNTED = [*DIMENSIONS, "kg_relation_type", "revision_need_type"]
ALL, NUMBERS, BREAK = "all", "numbers", "\x01"
REPRESENTATIVES = 3


def with_aliases(
    df: DataFrame, fields: Sequence[str], aliases: Mapping[str, Sequence[str]] = rules.FIELD_ALIASES
) -> DataFrame:
    """The alias columns of the fields as filled text; numbers stay numbers."""
    names = [name for f in fields for name in aliases.get(f, [f]) if name in df.columns]
    return v.with_filled(df, [name for name in names if not v.is_numeric(df, name)])


def resolve(df: DataFrame, field: str, aliases: Mapping[str, Sequence[str]] = rules.FIELD_ALIASES) -> Column:
    """A logical field as text: the first filled value among its alias columns.

    The frame must have gone through ``with_aliases``.
    """
    names = [name for name in aliases.get(field, [field]) if name in df.columns]
    values = [v.filled(F.col(name)) if v.is_numeric(df, name) else F.col(f"`{name}`") for name in names]
    return F.coalesce(*values, F.lit(""))


def resolve_fields(
    df: DataFrame,
    fields: Sequence[str] = tuple(rules.FIELD_ALIASES),
    aliases: Mapping[str, Sequence[str]] = rules.FIELD_ALIASES,
    keep: Sequence[str] = (),
) -> DataFrame:
    df = with_aliases(df, fields, aliases)
    return df.select(*keep, *[resolve(df, field, aliases).alias(field) for field in fields])


def missing_fields(
    columns: Sequence[str],
    required: Sequence[str] = tuple(rules.REQUIRED_FIELDS),
    aliases: Mapping[str, Sequence[str]] = rules.FIELD_ALIASES,
) -> list[str]:
    """Required logical fields without any alias column."""
    return [f for f in required if not set(aliases.get(f, [f])) & set(columns)]


def missing_field_report(
    df: DataFrame,
    required: Sequence[str] = tuple(rules.REQUIRED_FIELDS),
    aliases: Mapping[str, Sequence[str]] = rules.FIELD_ALIASES,
) -> DataFrame:
    """Per required field: is it missing, and how many rows count as empty."""
    missing = set(missing_fields(df.columns, required, aliases))
    df = with_aliases(df, required, aliases)
    totals = df.agg(*[F.count_if(resolve(df, f, aliases) == "").alias(f) for f in required])
    rows = [
        F.struct(F.lit(f).alias("field"), F.lit(f in missing).alias("missing"), F.col(f).alias("empty_rows"))
        for f in required
    ]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def expand(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row per issue and standard, all fields coerced.

    An issue with a standard of its own gives one row, otherwise one row per
    reference; issues without any standard drop out.  ``order_0``... carry the
    input order; the first of them is the place of an issue, counted from 0
    (``tables.with_position``), and names issues without an id, counted from 1.
    """
    texts = [
        "problem_id", "problem_text", *DIMENSIONS, "predicted_severity", "kg_standard_id",
        "kg_standard_name", "kg_standard_refs", "kg_clause_id", "kg_clause_title", "standard_no",
        "standard_status", "clause_no", "kg_relation_type", "revision_need_type", "need_review",
        "revision_demand",
    ]
    words = {"need_review", "revision_demand"}
    shares = [
        "category_confidence", "severity_confidence", "kg_relation_confidence",
        "standard_revision_priority_score",
    ]
    ordered = df.withColumns({f"order_{i}": F.col(name) for i, name in enumerate(order_by)})
    df = with_aliases(ordered, [*texts, *shares])
    read = df.select(
        *[f"order_{i}" for i in range(len(order_by))],
        *[(F.lower(resolve(df, name)) if name in words else resolve(df, name)).alias(name) for name in texts],
        *[v.first_share(df, rules.FIELD_ALIASES[name]).alias(name) for name in shares],
    )
    id_, name, demand = F.col("kg_standard_id"), F.col("kg_standard_name"), F.col("revision_demand")
    own = F.struct(
        F.when(id_ != "", id_).otherwise(v.hashed_id("standard", name, 10)).alias("kg_standard_id"),
        F.when(name != "", name).otherwise(id_).alias("kg_standard_name"),
    )
    listed = F.transform(
        v.split_refs(F.col("kg_standard_refs"), v.CLAUSE_REF_BREAK),
        lambda ref: F.struct(
            v.hashed_id("standard", ref, 10).alias("kg_standard_id"), ref.alias("kg_standard_name")
        ),
    )
    row_name = F.concat(F.lit("row_"), (F.col("order_0") + 1).cast("string"))
    shaped = read.withColumns(
        {
            "standard": F.when((id_ != "") | (name != ""), F.array(own)).otherwise(listed),
            "problem_id": F.when(F.col("problem_id") != "", F.col("problem_id")).otherwise(row_name),
            "kg_clause_title": F.when(F.col("kg_clause_id") != "", F.col("kg_clause_title")).otherwise(""),
            "need_review": v.is_demand(F.col("need_review")),
            "revision_demand": v.is_demand(demand) | demand.isin(rules.CERTAIN_DEMANDS),
        }
    ).drop("kg_standard_id", "kg_standard_name", "kg_standard_refs")
    rows = shaped.withColumn("standard", F.explode("standard"))
    return rows.select("standard.*", *[c for c in rows.columns if c != "standard"])


def low_confidence() -> Column:
    """The least of the known (positive) confidences is below the limit."""
    known = F.filter(
        F.array("category_confidence", "severity_confidence", "kg_relation_confidence"), lambda x: x > 0
    )
    return F.coalesce(F.array_min(known) < rules.LOW_CONFIDENCE, F.lit(False))


def order_columns(df: DataFrame) -> list[str]:
    return sorted((c for c in df.columns if c.startswith("order_")), key=lambda c: int(c[6:]))


def fold(expanded: DataFrame) -> DataFrame:
    """Rows counted per group, kind and value.

    Every row counts once under the kind ``all``, with its numbers, once under each counted column with its value, and
    once under ``numbers``.  Only numbers are aggregated, so this is one hash aggregation whose partial
    sums have a row per group and value of a task, and a clause that holds a large part of all rows
    arrives as a few of them.  Totals, distinct counts and distributions all start from its result; write it
    (``session.materialise``) where more than one of them is wanted.
    """
    rank = v.severity_rank(F.col("predicted_severity"))
    number = F.concat_ws(BREAK, "standard_no", "clause_no")
    thin = expanded.select(
        *GROUP, number.alias(NUMBERS), *COUNTED, "order_0",
        F.struct(
            (rank >= 3).alias("high"), (rank >= 2).alias("medium_high"), "revision_demand", "need_review",
            low_confidence().alias("low"), v.exact(F.col("kg_relation_confidence")).alias("confidence"),
            F.col("kg_relation_confidence").alias("confidence_as_is"),
            v.exact(F.col("standard_revision_priority_score")).alias("priority"),
            v.mapped(F.col("standard_status"), rules.STATUS_SCORES, 0.0).alias("status"),
        ).alias("own"),
    )
    # only the row of the kind ``all`` carries the numbers, so the sums of the others cost nothing
    none = F.lit(None)
    items = [(ALL, F.lit(""), F.col("own")), *((name, F.col(name), none) for name in (NUMBERS, *COUNTED))]
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), value.alias("value"), own.alias("own")) for k, value, own in items])
    rows = thin.select(*GROUP, "order_0", F.inline(listed)).select(*GROUP, "order_0", "kind", "value", "own.*")
    return rows.groupBy(*GROUP, "kind", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("high").alias("high"),
        F.count_if("medium_high").alias("medium_high"),
        F.count_if("revision_demand").alias("demand"),
        F.count_if("need_review").alias("review"),
        F.count_if("low").alias("low"),
        F.sum("confidence").alias("confidence_sum"),
        F.max("confidence_as_is").alias("confidence_max"),
        F.sum("priority").alias("priority_sum"),
        F.max("status").alias("status"),
        F.min("order_0").alias("first_at"),
    )


def aggregate(folded: DataFrame) -> DataFrame:
    """Counts, means, maxima and distinct dimension values per group."""
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, c))
    whole = lambda name: of(ALL, F.col(name))  # one row per group
    value, n = F.col("value"), whole("n")
    scores = {
        "status": whole("status"),
        "relation": of("kg_relation_type", v.mapped(value, rules.RELATION_SCORES, 0.0)),
        "need": of("revision_need_type", v.mapped(value, rules.NEED_SCORES, 0.0)),
    }
    context = reduce(Column.__add__, [weight * scores[name] for name, weight in rules.CONTEXT_WEIGHTS.items()])
    distinct = [F.count_if((F.col("kind") == name) & (value != "")).alias(f"{name}_count") for name in DIMENSIONS]
    first = F.min(F.when(F.col("kind") == NUMBERS, F.struct("first_at", "value")))
    per_group = folded.groupBy(*GROUP).agg(
        *[whole(name).alias(name) for name in ("n", "high", "medium_high", "demand", "review", "low")],
        (whole("confidence_sum").cast("double") / n).alias("confidence"),
        whole("confidence_max").alias("confidence_max"),
        (whole("priority_sum").cast("double") / n).alias("mean_priority"),
        context.alias("context"),
        *distinct,
        F.split(first["value"], BREAK).alias("first"),
    )
    return per_group.select(
        *GROUP,
        (F.col("kg_clause_id") == "").alias("clause_missing"),
        F.col("n").alias("related_problem_count"),
        F.col("high").alias("high_severity_problem_count"),
        F.col("medium_high").alias("medium_high_severity_problem_count"),
        F.col("demand").alias("revision_demand_count"),
        F.col("review").alias("manual_review_count"),
        F.col("low").alias("low_confidence_problem_count"),
        F.col("confidence").alias("mean_confidence"),
        F.col("confidence_max").alias("best_confidence"),
        "mean_priority",
        "context",
        *[f"{name}_count" for name in DIMENSIONS],
        F.get("first", F.lit(0)).alias("standard_no"),
        F.get("first", F.lit(1)).alias("clause_no"),
    )


def scored(groups: DataFrame, total: Column) -> DataFrame:
    """Groups with the seven score parts, the score, its level and the reason.

    ``total`` is the number of expanded rows, e.g. ``row_total(folded)``.
    """
    w, n = rules.RANKING_WEIGHTS, F.col("related_problem_count")
    high, medium = F.col("high_severity_problem_count"), F.col("medium_high_severity_problem_count")
    share = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    coverage = reduce(
        Column.__add__,
        [F.least(F.col(f"{name}_count") / float(full), F.lit(1.0)) for name, full in rules.COVERAGE_FULL.items()],
    ) / float(len(rules.COVERAGE_FULL))
    parts = groups.withColumns(
        {
            "frequency": share(n / F.greatest(F.lit(3), F.least(total, F.lit(10)))),
            "severity": share((high + 0.6 * (medium - high)) / n),
            "demand": share(F.col("revision_demand_count") / n),
            "confidence": share(F.col("mean_confidence")),
            "coverage": share(coverage),
            "existing": F.greatest("mean_priority", "context"),
            "uncertainty": share(
                F.greatest(F.col("manual_review_count") / n, F.col("low_confidence_problem_count") / n)
            ),
        }
    )
    mixed = reduce(
        Column.__add__,
        [w[name] * F.col(name) for name in ("frequency", "severity", "demand", "confidence", "coverage", "existing")],
    ) - w["uncertainty"] * F.col("uncertainty")
    parts = parts.withColumn("score", v.rounded(share(mixed) * 100.0, 2))
    return parts.withColumns({"level": level_of(F.col("score")), "reason": reason_of()})


def level_of(score: Column) -> Column:
    out = F.lit(rules.RANKING_LEVEL_OTHER)
    for cut, name in reversed(rules.RANKING_LEVELS):
        out = F.when(score >= cut, name).otherwise(out)
    return out


def reason_of() -> Column:
    say, n = rules.RANKING_PHRASES, F.col("related_problem_count")
    high, demand = F.col("high_severity_problem_count"), F.col("revision_demand_count")
    return F.concat(
        F.lit(say["lead"]),
        F.concat_ws(
            "，",
            F.when(n >= 5, say["count_many"]).when(n >= 2, say["count_some"]).otherwise(say["count_few"]),
            F.when(high / n >= 0.4, say["high_share"])
            .when(high > 0, say["high_some"])
            .when(F.col("medium_high_severity_problem_count") > 0, say["medium_some"]),
            F.when(demand >= 2, say["demand_many"]).when(demand > 0, say["demand_some"]).otherwise(say["demand_none"]),
            F.when(F.col("mean_confidence") >= 0.75, say["confidence_high"])
            .when(F.col("mean_confidence") > 0, say["confidence_some"]),
            F.when(F.col("coverage") >= 0.5, say["coverage"]),
            F.when(F.col("uncertainty") >= 0.4, say["uncertain"]),
            F.when(F.col("score") >= 60, say["advice_now"]).otherwise(say["advice_later"]),
        ),
    )


def row_total(folded: DataFrame) -> Column:
    """Number of expanded rows as a scalar subquery."""
    return folded.where(F.col("kind") == ALL).agg(F.sum("n").alias("rows")).scalar()


def distribution(folded: DataFrame, column: str, out: str) -> DataFrame:
    """Value counts of a column per group as JSON with sorted keys."""
    counts = folded.filter((F.col("kind") == column) & (F.col("value") != ""))
    listed = F.sort_array(F.collect_list(F.struct("value", "n")))
    return counts.groupBy(*GROUP).agg(F.to_json(F.map_from_entries(listed)).alias(out))


def representatives(expanded: DataFrame, limit: int = REPRESENTATIVES) -> DataFrame:
    """The most telling issues per group, ids and texts joined in rank order."""
    telling = Window.partitionBy(*GROUP).orderBy(
        F.desc("severity"),
        F.desc("kg_relation_confidence"),
        F.desc("standard_revision_priority_score"),
        F.desc("has_text"),
        *order_columns(expanded),
    )
    thin = expanded.select(
        *GROUP, "problem_id", "problem_text", "kg_relation_confidence", "standard_revision_priority_score",
        v.severity_rank(F.col("predicted_severity")).alias("severity"),
        (F.col("problem_text") != "").alias("has_text"),
        *order_columns(expanded),
    )
    kept = thin.withColumn("n", F.row_number().over(telling)).filter(F.col("n") <= limit)
    listed = F.sort_array(F.collect_list(F.struct("n", "problem_id", "problem_text")))
    texts = F.filter(F.col("r.problem_text"), lambda x: x != "")
    return (
        kept.groupBy(*GROUP)
        .agg(listed.alias("r"))
        .select(
            *GROUP,
            F.concat_ws("；", F.col("r.problem_id")).alias("representative_problem_ids"),
            F.concat_ws("；", texts).alias("representative_problem_texts"),
        )
    )


def best_groups(folded: DataFrame, top_k: int = 50, min_count: int = 1) -> DataFrame:
    """The k groups with the highest score, scored and ranked."""
    groups = scored(aggregate(folded), row_total(folded))
    order = [F.desc("score"), F.desc("related_problem_count"), F.desc("best_confidence"), *GROUP]
    best = groups.filter(F.col("related_problem_count") >= min_count).orderBy(*order).limit(top_k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank(expanded: DataFrame, top_k: int = 50, min_count: int = 1) -> DataFrame:
    """The k clauses with the highest score, with all 37 report columns.

    The expanded rows are written once, and folded once; what is on the list, its distributions and its
    representatives are read from these two tables.
    """
    expanded = materialise(expanded)
    folded = materialise(fold(expanded))
    best = materialise(best_groups(folded, top_k, min_count))
    keys = F.broadcast(best.select(*GROUP))  # at most top_k rows
    listed = folded.join(keys, GROUP, "left_semi")
    full = best
    for extra in (
        representatives(expanded.join(keys, GROUP, "left_semi")),
        distribution(listed, "kg_relation_type", "relation_type_distribution"),
        distribution(listed, "revision_need_type", "revision_need_type_distribution"),
    ):
        full = full.join(extra, GROUP, "left")
    full = full.na.fill("{}", ["relation_type_distribution", "revision_need_type_distribution"])
    confidence = v.rounded(F.col("mean_confidence"), 4)
    out = {
        "rank": F.col("rank"),
        **{name: F.col(name) for name in GROUP},
        **{
            name: F.col(name)
            for name in (
                "clause_missing", "related_problem_count", "high_severity_problem_count",
                "medium_high_severity_problem_count", "revision_demand_count", "manual_review_count",
                "low_confidence_problem_count",
            )
        },
        "avg_relation_confidence": confidence,
        "max_relation_confidence": v.rounded(F.col("best_confidence"), 4),
        "avg_standard_revision_priority_score": v.rounded(F.col("existing"), 4),
        **{f"{name}_count": F.col(f"{name}_count") for name in DIMENSIONS},
        "aggregated_priority_score": F.col("score"),
        "aggregated_priority_level": F.col("level"),
        "aggregated_priority_reason": F.col("reason"),
        "representative_problem_ids": F.col("representative_problem_ids"),
        "representative_problem_texts": F.col("representative_problem_texts"),
        "standard_id": F.col("kg_standard_id"),
        "standard_name": F.col("kg_standard_name"),
        "standard_no": F.col("standard_no"),
        "clause_id": F.col("kg_clause_id"),
        "clause_no": F.col("clause_no"),
        "problem_count": F.col("related_problem_count"),
        "high_risk_problem_count": F.col("high_severity_problem_count"),
        "avg_match_confidence": confidence,
        "relation_type_distribution": F.col("relation_type_distribution"),
        "revision_need_type_distribution": F.col("revision_need_type_distribution"),
        "revision_priority_score": F.col("score"),
        "revision_priority_level": F.col("level"),
        "revision_reason_summary": F.col("reason"),
    }
    return full.select(*[c.alias(name) for name, c in out.items()]).orderBy("rank")


def summary(folded: DataFrame, top_k: int = 50, min_count: int = 1) -> DataFrame:
    """Eight totals over the ranked list and over all expanded rows, in one row."""
    one = F.count(F.lit(1))
    level = F.col("level")
    rows = folded.where(F.col("kind") == ALL).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (
            ("n", "total_related_problems"), ("review", "manual_review_problem_count"), ("low", "low_confidence_problem_count"),
        )],
        F.lit(1).alias("one"),
    )
    listed = best_groups(folded, top_k, min_count).agg(
        one.alias("aggregated_item_count"),
        F.count_distinct("kg_standard_id").alias("standard_count"),
        F.count_if(~F.col("clause_missing")).alias("clause_count"),
        F.count_if(level == rules.RANKING_LEVELS[0][1]).alias("high_priority_count"),
        F.count_if(level == rules.RANKING_LEVELS[1][1]).alias("medium_high_priority_count"),
        F.lit(1).alias("one"),
    )
    return rows.join(listed, "one").select(
        "total_related_problems", "aggregated_item_count", "standard_count", "clause_count",
        "high_priority_count", "medium_high_priority_count", "manual_review_problem_count",
        "low_confidence_problem_count",
    )
