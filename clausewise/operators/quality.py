"""Output checks: fill rates, value distributions, validity of linked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v

DECISION_COLUMNS = [
    "pred_level", "pred_category", "level_confidence", "category_confidence", "priority_score",
    "priority_label", "priority_reason", "suggestion", "suggestion_basis", "recommended_action",
]


def fill_rate(
    df: DataFrame, columns: Sequence[str] = tuple(DECISION_COLUMNS), spread: Sequence[str] = ()
) -> DataFrame:
    """Long table (kind, column, value, rows, rate).

    ``fill`` rows give the share of non-blank values per column, ``value`` rows
    the counts per non-blank value of the ``spread`` columns; both come from
    one grouping over one read of the table.
    """
    present = [name for name in columns if name in df.columns]
    text = lambda name: v.text_of(F.col(name))
    entry = lambda kind, name, value: F.struct(
        F.lit(kind).alias("kind"), F.lit(name).alias("column"), value.alias("value")
    )
    items = [entry("fill", name, F.when(text(name) != "", "y").otherwise("n")) for name in present]
    items += [F.when(text(name) != "", entry("value", name, F.col(name).cast("string"))) for name in spread]
    counted = (
        df.select(F.explode(F.array(*items)).alias("e"))
        .filter("e IS NOT NULL")
        .groupBy("e.kind", "e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    yes = F.sum(F.when(F.col("value") == "y", F.col("rows")).otherwise(0))
    fill = (
        counted.filter("kind = 'fill'")
        .groupBy("kind", "column")
        .agg(yes.alias("rows"), v.rounded(yes / F.sum("rows"), 4).alias("rate"))
        .select("kind", "column", F.lit("").alias("value"), "rows", "rate")
    )
    values = counted.filter("kind = 'value'").select(
        "kind", "column", "value", "rows", F.lit(None).cast("double").alias("rate")
    )
    return fill.unionByName(values)


def validate_links(df: DataFrame, warning_threshold: float = 0.5) -> DataFrame:
    """One row: missing rates, counts of invalid values, PASS or WARNING with the reasons."""
    missing = [name for name in rules.LINKED_FIELDS if name not in df.columns]
    df = df.withColumns({name: F.lit("") for name in missing})
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    number = v.to_number(F.col("standard_match_confidence"))
    n = F.count(F.lit(1))
    blank_rate = lambda name: F.when(n > 0, F.count_if(v.strip(text(name)) == "") / n).otherwise(0.0)
    outside = lambda name, allowed: F.count_if(~text(name).isin(allowed))
    counted = df.agg(
        n.alias("total_records"),
        blank_rate("related_standard_name").alias("missing_related_standard_name_rate"),
        blank_rate("related_clause_text").alias("missing_related_clause_text_rate"),
        F.count_if(number.isNull() | (number < 0) | (number > 1)).alias("invalid_confidence"),
        outside("problem_standard_relation_type", rules.VALID_RELATIONS).alias("invalid_relation_type"),
        outside("revision_need_type", rules.VALID_NEEDS).alias("invalid_revision_need_type"),
        outside("standard_revision_priority_initial", rules.VALID_PRIORITIES).alias("invalid_priority"),
        outside("graph_relation_type", rules.VALID_GRAPH_RELATIONS).alias("invalid_graph_relation_type"),
    )
    rate = F.col("missing_related_clause_text_rate")
    too_many = rate > warning_threshold
    warnings = F.concat_ws(
        "; ",
        F.lit("missing fields: " + ", ".join(missing)) if missing else F.lit(None).cast("string"),
        F.when(
            too_many,
            F.concat(
                F.lit("related_clause_text missing rate "),
                v.fixed(rate * 100, 2),
                F.lit(f"% exceeds {warning_threshold:.0%}"),
            ),
        ),
    )
    return counted.withColumns(
        {"status": F.when(F.lit(bool(missing)) | too_many, "WARNING").otherwise("PASS"), "warnings": warnings}
    )
