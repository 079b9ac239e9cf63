"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from clausewise import rules
from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.operators import (
    cleaning,
    decision,
    evaluation,
    feedback,
    graph,
    learning,
    linking,
    numbering,
    quality,
    ranking,
    review,
    revision,
    splits,
)
from clausewise.operators.stages import canonical_stage
from clausewise.plans import vocabulary as words
from clausewise.plans.views import LINES_BY_ORDER, table, view
from clausewise.session import keep_compiled, materialise, shared_dir
from clausewise.sources import library, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Pairs per left row that the similarity queries return.
BEST = 3


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        keep_compiled(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def listed(c: Column, ordered: bool = False) -> Column:
    """An array as one text; arrays whose order means nothing are sorted first."""
    return F.array_join(c if ordered else F.array_sort(c), "|")


def best(pairs: DataFrame, of: str, order: list) -> DataFrame:
    """The first BEST pairs of each left row; tasks drop the others before any shuffle."""
    place = F.row_number().over(Window.partitionBy(of).orderBy(*order))
    return pairs.withColumn("_n", place).filter(F.col("_n") <= BEST).drop("_n")


def flags_as_text(df: DataFrame) -> DataFrame:
    bools = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    return df.withColumns({name: F.col(name).cast("string") for name in bools})


# ---------------------------------------------------------- sources and sinks


def _round_trip(df: DataFrame, suffix: str) -> DataFrame:
    spark = df.sparkSession
    path = tables.write_table(df, f"{shared_dir(spark)}/table{suffix}", escaped_breaks=True, compression="lz4")
    return tables.read_table(spark, path, df.schema, escaped_breaks=True)


@query
def scan_csv(spark, sf):
    """Documents, quotes and line breaks and all, as CSV."""
    return _round_trip(table(spark, sf, "documents"), ".csv")


@query
def scan_jsonl(spark, sf):
    return _round_trip(table(spark, sf, "documents"), ".jsonl")


@query
def sink_csv(spark, sf):
    """All linked issues, written and read back."""
    return _round_trip(view(spark, sf, "linked_issues", LINES_BY_ORDER), ".csv")


@query
def sink_jsonl(spark, sf):
    return _round_trip(view(spark, sf, "linked_issues"), ".jsonl")


def _library(spark, sf):
    return view(spark, sf, "standards"), view(spark, sf, "clauses")


def _points(spark, sf):
    return library.points_from_library(*_library(spark, sf))


def _flat_points(points: DataFrame) -> DataFrame:
    arrays = {name: listed(F.col(name), ordered=True) for name in ("standards", "requirements", "keywords")}
    return points.withColumns(arrays)


@query
def kg_points_from_library(spark, sf):
    return _flat_points(_points(spark, sf))


@query
def kg_points_from_graph(spark, sf):
    points = library.points_from_graph(view(spark, sf, "graph_nodes"), view(spark, sf, "graph_links"))
    return _flat_points(points).select(
        "point_id", "point_pos", "label", "full_text", "equipment", "stage", "severity", "project",
        "standards", "requirements",
    )


@query
def kg_supported_equipment(spark, sf):
    by_library = library.equipment_of_library(*_library(spark, sf))
    by_graph = library.equipment_of_graph(view(spark, sf, "graph_nodes"))
    return by_library.withColumn("form", F.lit("library")).unionByName(by_graph.withColumn("form", F.lit("graph")))


# ------------------------------------------ projection, filtering and cleaning


@query
def issue_rename(spark, sf):
    return cleaning.rename_issues(view(spark, sf, "raw_issues"), keep=["row_pos"])


@query
def issue_clean_text(spark, sf):
    named = cleaning.rename_issues(view(spark, sf, "raw_issues"), keep=["row_pos"])
    texts = [name for name in rules.RAW_COLUMNS.values() if name not in rules.DATE_COLUMNS]
    return cleaning.clean_columns(named, texts).drop(*rules.DATE_COLUMNS)


@query
def issue_clean_date(spark, sf):
    """Order dates in several spellings, and some that are no dates."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 25
    spelled = (
        F.when(k == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(day, "yyyy/M/d"))
        .when(k == 2, F.date_format(day, "yyyy.MM.dd"))
        .when(k == 3, F.date_format(day, "yyyyMMdd"))
        .when(k == 4, F.date_format(day, "M/d/yyyy"))
        .when(k == 5, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(k == 6, F.concat(F.lit(" week  of "), F.date_format(day, "yyyy")))
        .when(k == 7, F.lit("NaN"))
        .when(k == 9, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(k == 10, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 11, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+08:00'"))
        .when(k == 12, F.date_format(day, "MMM d, yyyy"))
        .when(k == 13, F.date_format(day, "d MMMM yyyy"))
        .when(k == 14, F.date_format(day, "MMMM d yyyy"))
        .when(k == 15, F.date_format(day, "yyyy-MM"))
        .when(k == 16, F.date_format("o_orderdate", "yyyyMMddHHmmss"))
        .when(k == 17, F.date_format(day, "MM-dd-yyyy"))
        .when(k == 18, F.date_format("o_orderdate", "M/d/yyyy HH:mm"))
        .when(k == 19, F.date_format(day, "d-MMM-yyyy"))
        .when(k == 20, F.date_format(day, "EEEE, MMMM d, yyyy"))
        .when(k == 21, F.date_format("o_orderdate", "yyyy/M/d HH:mm"))
        .when(k == 22, F.concat(F.date_format(day, "yyyy"), F.lit("年"), F.date_format(day, "M"), F.lit("月")))
        .when(k == 23, F.date_format("o_orderdate", "M/d/yyyy h:mm a"))
        .when(k == 24, F.date_format("o_orderdate", "yyyy-MM-dd hh:mm:ss a"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", spelled.alias("event_time"))
    return cleaning.clean_columns(orders, [], ["event_time"])


def _cleaned(spark, sf):
    """Valid raw issues, cleaned."""
    named = cleaning.rename_issues(view(spark, sf, "raw_issues"), keep=["row_pos"])
    texts = [name for name in rules.RAW_COLUMNS.values() if name not in rules.DATE_COLUMNS]
    return cleaning.clean_columns(cleaning.keep_valid(named), texts, rules.DATE_COLUMNS)


@query
def issue_filter_valid(spark, sf):
    return _cleaned(spark, sf).select("row_pos", "text", "label")


@query
def issue_dedupe_first(spark, sf):
    kept = _cleaned(spark, sf).select("row_pos", *rules.REPEAT_KEYS)
    return cleaning.drop_repeats(kept, ["row_pos"])


@query
def issue_assign_id(spark, sf):
    prepared = cleaning.prepare_issues(view(spark, sf, "raw_issues"), "row_pos")
    return prepared.select("sample_id", "row_pos", "text", "label", "event_time", "source_unit", "data_source")


@query
def issue_fill_ids(spark, sf):
    docs = view(spark, sf, "doc_issues").select(
        "row_pos",
        F.when(F.col("row_pos") % 3 == 0, None)
        .when(F.col("row_pos") % 3 == 1, " ")
        .otherwise(F.col("sample_id"))
        .alias("sample_id"),
    )
    return numbering.fill_ids(docs, "row_pos", prefix="pred")


@query
def alias_resolve(spark, sf):
    return ranking.resolve_fields(view(spark, sf, "linked_issues"))


@query
def alias_missing_fields(spark, sf):
    df = view(spark, sf, "linked_issues").drop("region", "kg_clause_title")
    return flags_as_text(ranking.missing_field_report(df))


@query
def text_normalise(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("　（a）；"), "text", F.lit("。 ")).alias("text"))
    return docs.select(
        "doc_id",
        t.normalised(F.col("text"), words.TERMS).alias("plain"),
        t.normalised(F.col("text"), words.TERMS, lowercase=True, punctuation=False).alias("lowered"),
        t.normalised(t.normalised(F.col("text"), words.TERMS), words.TERMS).alias("twice"),
    )


def _model_input(spark, sf):
    docs = view(spark, sf, "doc_issues").select("row_pos", "text", "device_type", "specialty", "rule_name", "label")
    return cleaning.model_input(
        docs,
        fields=["device_type", "specialty", "rule_name", "absent"],
        aliases=words.FIELD_NAMES,
        terms_map=words.TERMS,
    )


@query
def model_input_build(spark, sf):
    return _model_input(spark, sf).select("row_pos", "model_input")


def _categorised(spark, sf):
    docs = view(spark, sf, "doc_issues").withColumn("data_source", F.when(F.col("row_pos") % 2 == 0, "docs"))
    return cleaning.category_dataset(docs, words.CATEGORY_RULES, words.CATEGORY_DEFAULT)


@query
def category_rules(spark, sf):
    docs = view(spark, sf, "doc_issues")
    category = cleaning.category_of(docs, words.CATEGORY_RULES, words.CATEGORY_DEFAULT)
    return docs.select("row_pos", category.alias("category"))


@query
def category_dataset(spark, sf):
    return _categorised(spark, sf).select("row_pos", "problem_level", "label", "data_source")


def _predictions(spark, sf):
    """Order lines with a generic prediction and a second, filled category."""
    df = view(spark, sf, "linked_issues")
    return df.select(
        "order_no",
        F.col("problem_id").alias("sample_id"),
        F.col("problem_text").alias("text"),
        "device_type",
        F.col("predicted_severity").alias("predicted_label"),
        F.when(F.col("severity_confidence") < 0.6, "n/a")
        .otherwise(F.col("severity_confidence").cast("string"))
        .alias("confidence"),
        F.col("predicted_category").alias("pred_category"),
        "category_confidence",
        "repeat_count",
        F.col("need_review").alias("need_manual_review"),
    )


@query
def primary_role_columns(spark, sf):
    """The same prediction once as a level and once, without other columns, as a category."""
    df = decision.role_columns(_predictions(spark, sf), decision.primary_role("issue_level", "label"))
    bare = df.drop("pred_category", "category_confidence").withColumnRenamed("pred_level", "as_level")
    bare = bare.withColumnRenamed("level_confidence", "as_level_confidence")
    both = decision.role_columns(bare, decision.primary_role("kind", "label"))
    return both.select(
        "sample_id",
        F.col("as_level").alias("pred_level"),
        F.col("as_level_confidence").alias("level_confidence"),
        F.col("pred_category").alias("as_category"),
        F.col("category_confidence").alias("as_confidence"),
    )


@query
def stage_alias(spark, sf):
    docs = v.with_filled(view(spark, sf, "doc_issues"), ["supervision_stage"])
    return docs.select("row_pos", canonical_stage(F.col("supervision_stage")).alias("stage"))


@query
def review_rename_columns(spark, sf):
    decided = _decided(spark, sf).withColumn("suggested_basis", F.when(F.col("repeat_count") == 1, "own"))
    return flags_as_text(review.display_columns(review.review_rows(decided)))


# ---------------------------------------------------------------------- joins


@query
def join_clause_standard(spark, sf):
    standards, clauses = _library(spark, sf)
    return library.clauses_with_standard(clauses, standards).select(
        "clause_id", "standard_id", "clause_no", *library.STANDARD_FIELDS, "standard_equipment"
    )


@query
def join_graph_links(spark, sf):
    links = library.point_links(view(spark, sf, "graph_nodes"), view(spark, sf, "graph_links"))
    return links.groupBy("point_id", "edge_type", "other_reference").agg(
        F.count(F.lit(1)).alias("links"), F.min("link_pos").alias("first_pos"), F.max("link_pos").alias("last_pos")
    )


def _long_names(spark, sf):
    """Equipment of the library and the long words of the clauses."""
    found = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{9,}"), F.lit(0)))
    long_words = table(spark, sf, "benchmark").select(found.alias("name"))
    return library.equipment_of_library(*_library(spark, sf)).unionByName(long_words).distinct()


@query
def join_equipment_contains(spark, sf):
    docs = view(spark, sf, "doc_issues").select("row_pos", "device_type", "rule_name", "text")
    return linking.with_equipment(docs, _long_names(spark, sf), "row_pos").select("row_pos", "equipment")


@query
def join_candidates(spark, sf):
    """Every issue with each clause it is compared with."""
    docs = view(spark, sf, "doc_issues").select("row_pos", "device_type", "rule_name")
    names = library.equipment_of_library(*_library(spark, sf))
    found = linking.with_equipment(docs, names, "row_pos").select("row_pos", "equipment")
    return linking.candidates(found, _points(spark, sf), names, "row_pos")


def _links(spark, sf, **options):
    return linking.link(
        view(spark, sf, "doc_issues"), _points(spark, sf),
        library.equipment_of_library(*_library(spark, sf)), "row_pos", **options,
    )


@query
def antijoin_unlinked(spark, sf):
    return linking.with_status(_links(spark, sf)).filter("kg_match_status != 'matched'").select(
        "row_pos", "equipment", "kg_match_status"
    )


@query
def join_feedback(spark, sf):
    labels = feedback.accepted_labels(view(spark, sf, "reviews"), ["review_no"])
    docs = view(spark, sf, "doc_issues").select("sample_id", "label")
    return feedback.join_feedback(docs, labels)


@query
def join_category_prediction(spark, sf):
    docs = view(spark, sf, "doc_issues").select("sample_id", "pred_category")
    second = view(spark, sf, "guesses").select(
        F.concat(F.lit("D"), "doc_id").alias("sample_id"),
        "predicted_label",
        (F.col("good_logit") / 10).cast("string").alias("confidence"),
        F.length("predicted_label").cast("bigint").alias("predicted_label_id"),
    )
    return decision.attach_category(docs, second)


@query
def join_feature_vector(spark, sf):
    """All documents with the eleven issue columns; vectors are dealt to them in turn, so every one has its vector."""
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    docs = view(spark, sf, "doc_issues").withColumns(
        {"level_confidence": F.col("priority_score"), "need_review": F.col("toxic") == 1}
    )
    count = vectors.select(F.count(F.lit(1))).scalar()
    place = docs.select(F.col("sample_id"), F.pmod("row_pos", count).alias("vec_id"))
    issues = learning.feature_columns(docs).join(place, "sample_id")
    return flags_as_text(learning.feature_matrix(issues, vectors, "vec_id", dim=64))


# ----------------------------------------------- text similarity and matching


@query
def token_sets(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    grams = t.grams(F.col("clean"))
    return docs.withColumn("clean", t.cleaned(F.col("text"))).select(
        "doc_id", "clean", listed(grams).alias("grams"), listed(t.terms(F.col("text"))).alias("terms"),
    )


@query
def text_similarity(spark, sf):
    """The clauses of its source that are most like a document, so many rows per document at most."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("equipment"))
    items = table(spark, sf, "benchmark").select(
        "item_id", "text", F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("equipment")
    )
    left = t.with_tokens(docs, {"left": F.col("text")}).drop("text")
    right = t.with_tokens(items, {"right": F.col("text")}).drop("text")
    pairs = left.join(right, "equipment")
    alike = pairs.select("doc_id", "item_id", t.similarity(F.col("left"), F.col("right")).alias("similarity"))
    return best(alike.filter("similarity > 0"), "doc_id", [F.desc("similarity"), "item_id"])


@query
def keyword_overlap(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("equipment"))
    clauses = view(spark, sf, "clauses").filter("equipment_type != ''")
    pairs = docs.join(clauses.select(F.col("equipment_type").alias("equipment"), "pos", "keywords"), "equipment")
    hits = pairs.withColumn("hits", t.keyword_hits(F.col("keywords"), F.col("text")))
    share = F.when(F.size("keywords") > 0, F.col("hits") / F.size("keywords")).otherwise(0.0)
    hits = hits.select("doc_id", "pos", F.col("hits").cast("bigint").alias("hits"), v.rounded(share, 4).alias("share"))
    return best(hits.filter("hits > 0"), "doc_id", [F.desc("share"), F.desc("hits"), "pos"])


@query
def match_score(spark, sf):
    """The part scores of the clauses that an issue is most like, whatever their score."""
    return _links(spark, sf, min_score=0.0).matches.select(
        "row_pos", "point_id", "checkpoint_score", "issue_score",
        v.rounded(F.col("keyword_score"), 6).alias("keyword_score"), "category_score",
        "opinion_score", "rule_score", "stage_score", "severity_score", "score", "reason",
    )


@query
def match_topk(spark, sf):
    return _links(spark, sf).matches.select(
        "row_pos", "point_id", "score", F.col("rank").cast("bigint").alias("rank"), "reason"
    )


@query
def match_topk_nested(spark, sf):
    return linking.nested_matches(_links(spark, sf), _points(spark, sf))


def _enriched(spark, sf):
    standards, clauses = _library(spark, sf)
    return linking.enrich_issues(
        view(spark, sf, "doc_issues"), library.points_from_library(standards, clauses),
        library.equipment_of_library(standards, clauses), "row_pos", revision_rules=words.REVISION_RULES,
    )


ENRICHED_COLUMNS = [
    "row_pos", "problem_id", "kg_match_status", "kg_match_score", "kg_point_id", "kg_point_text",
    "kg_project", "kg_stage", "kg_severity", "kg_standard_refs", "kg_requirement_texts",
    "kg_top_matches", "related_standard_id", "related_standard_name", "related_standard_no",
    "related_clause_id", "related_clause_no", "related_clause_text", "standard_match_confidence",
    "problem_standard_relation_type", "standard_status", "standard_revision_trigger_evidence",
    "standard_revision_priority_initial", "graph_problem_node_id", "graph_standard_node_id",
    "graph_clause_node_id", "graph_relation_type", "kg_standard_id", "kg_standard_name",
    "kg_clause_id", "kg_clause_title", "kg_relation_type", "kg_relation_confidence",
    "revision_need", "revision_need_type", "revision_priority_score", "revision_priority_label",
    "revision_reason",
]


@query
def issue_enrich_kg(spark, sf):
    return flags_as_text(_enriched(spark, sf).select(*ENRICHED_COLUMNS))


# ------------------------------------------------------------- decision rules


def _decided(spark, sf):
    return decision.decide(_predictions(spark, sf), "level", priority_rules=words.PRIORITY_OVERRIDES)


@query
def review_flag(spark, sf):
    df = decision.role_columns(_predictions(spark, sf), "level")
    return flags_as_text(df.select("sample_id", decision.review_flag(df).alias("need_review")))


PRIORITY_COLUMNS = [
    "priority_score", "priority_label", "priority_reason", "level_score", "device_score",
    "category_score", "repeat_score", "confidence_score",
]


@query
def priority_score(spark, sf):
    df = decision.role_columns(_predictions(spark, sf), "level")
    scored = decision.with_priority(df, rules.merged(rules.PRIORITY_RULES, words.PRIORITY_OVERRIDES))
    return scored.select("sample_id", *PRIORITY_COLUMNS)


@query
def suggestion_rules(spark, sf):
    df = _predictions(spark, sf).withColumn("priority_label", F.when(F.col("repeat_count") > 3, "高").otherwise("低"))
    return decision.with_advice(df).select("sample_id", "suggestion", "suggestion_basis", "recommended_action")


@query
def decision_enrich(spark, sf):
    return flags_as_text(
        _decided(spark, sf).select(
            "sample_id", "pred_level", "pred_category", "level_confidence", "category_confidence", "need_review",
            *PRIORITY_COLUMNS, "suggestion", "suggestion_basis", "recommended_action",
        )
    )


def _needs(spark, sf):
    """Documents with a given match status and standard status."""
    df = view(spark, sf, "doc_issues")
    return df.withColumns(
        {
            "is_matched": F.col("row_pos") % 8 != 0,
            "status": F.when(F.col("row_pos") % 3 == 0, "待修订").when(F.col("row_pos") % 3 == 1, "现行"),
            "match_score": F.when(F.col("row_pos") % 8 != 0, (F.col("row_pos") % 100) / 100.0).otherwise(0.0),
        }
    )


@query
def revision_need(spark, sf):
    df = revision.with_revision(
        _needs(spark, sf), F.col("is_matched"), F.col("status"), F.concat_ws(" ", "specialty", "rule_name"),
        F.col("match_score"), words.REVISION_RULES,
    )
    return flags_as_text(df.select("row_pos", "revision_need", "revision_need_type", "revision_reason"))


@query
def revision_priority(spark, sf):
    df = revision.with_revision(
        _needs(spark, sf), F.col("is_matched"), F.col("status"), F.lit(""), F.col("match_score"), words.REVISION_RULES
    )
    return df.select("row_pos", "revision_priority_score", "revision_priority_label")


@query
def relation_type(spark, sf):
    df = revision.with_revision(
        _needs(spark, sf), F.col("is_matched"), F.col("status"), F.lit(""), F.col("match_score"), words.REVISION_RULES
    )
    relation = revision.relation_of(F.col("is_matched"), F.col("revision_need_type"), F.col("status"))
    return df.select("row_pos", relation.alias("relation_type"))


@query
def final_label(spark, sf):
    last = feedback.last_per(view(spark, sf, "reviews"), "sample_id", ["review_no"])
    docs = view(spark, sf, "doc_issues").select(
        "sample_id",
        F.when(F.col("row_pos") % 5 == 0, "nan").otherwise(F.col("label")).alias("label"),
        F.when(F.col("row_pos") % 2 == 0, F.col("specialty")).alias("predicted_label"),
    )
    df = v.with_filled(docs.join(last, "sample_id", "left"), decision.LABEL_FIELDS)
    return flags_as_text(df.select("sample_id", *[c.alias(n) for n, c in decision.confirmed_label_columns(df).items()]))


# --------------------------------------------------------------- aggregations


def _reportable(spark, sf):
    """Order lines with the columns a linking run adds."""
    df = view(spark, sf, "linked_issues")
    return df.select(
        "order_no",
        F.col("problem_id").alias("sample_id"),
        F.concat_ws("; ", "kg_standard_name", F.when(F.col("repeat_count") == 1, F.concat(F.lit("标准 "), "device_type"))).alias(
            "kg_standard_refs"
        ),
        F.when(F.col("revision_demand") == "TRUE", "true").otherwise("no").alias("revision_need"),
        "revision_need_type",
        F.col("predicted_severity"),
        v.rounded(F.col("severity_confidence") * 0.9, 4).alias("priority_score"),
        v.rounded(F.col("kg_relation_confidence"), 4).alias("kg_match_score"),
        v.rounded(F.col("kg_relation_confidence") * F.col("category_confidence"), 4).alias("revision_priority_score"),
        F.when(F.col("repeat_count") == 6, "low_score").when(F.col("repeat_count") == 5, "unsupported_equipment").otherwise("matched").alias(
            "kg_match_status"
        ),
    )


@query
def standard_report(spark, sf):
    return revision.standard_report(_reportable(spark, sf), ["order_no", "sample_id"])


@query
def link_report(spark, sf):
    return revision.link_report(_reportable(spark, sf), ["order_no", "sample_id"])


def _expanded(spark, sf):
    return ranking.expand(view(spark, sf, "linked_issues"), ["order_no", "problem_id"])


@query
def clause_expand(spark, sf):
    return flags_as_text(_expanded(spark, sf).drop("order_0", "order_1"))


@query
def clause_aggregate(spark, sf):
    groups = ranking.aggregate(ranking.fold(_expanded(spark, sf)))
    out = groups.withColumns(
        {name: v.rounded(F.col(name), 4) for name in ("mean_confidence", "best_confidence", "mean_priority", "context")}
    )
    return flags_as_text(out)


def _scored_clauses(spark, sf):
    folded = materialise(ranking.fold(_expanded(spark, sf)))
    return ranking.scored(ranking.aggregate(folded), ranking.row_total(folded))


@query
def clause_score(spark, sf):
    parts = ["frequency", "severity", "demand", "confidence", "coverage", "existing", "uncertainty"]
    return _scored_clauses(spark, sf).select(
        *ranking.GROUP, *[v.rounded(F.col(name), 4).alias(name) for name in parts], "score", "level", "reason"
    )


@query
def clause_context_priority(spark, sf):
    groups = ranking.aggregate(ranking.fold(_expanded(spark, sf)))
    return groups.select(
        *ranking.GROUP,
        v.rounded(F.col("context"), 4).alias("context"),
        v.rounded(F.greatest("mean_priority", "context"), 4).alias("existing"),
    )


@query
def clause_distribution(spark, sf):
    folded = materialise(ranking.fold(_expanded(spark, sf)))
    relations = ranking.distribution(folded, "kg_relation_type", "relation_type_distribution")
    needs = ranking.distribution(folded, "revision_need_type", "revision_need_type_distribution")
    return relations.join(needs, ranking.GROUP, "full")


@query
def clause_representatives(spark, sf):
    return ranking.representatives(_expanded(spark, sf))


@query
def clause_rank(spark, sf):
    return flags_as_text(ranking.rank(_expanded(spark, sf)))


@query
def clause_summary(spark, sf):
    return ranking.summary(materialise(ranking.fold(_expanded(spark, sf))))


@query
def dataset_stats(spark, sf):
    raw = view(spark, sf, "raw_issues")
    prepared = cleaning.drop_repeats(_cleaned(spark, sf), ["row_pos"])
    return cleaning.dataset_stats(raw, prepared, ["specialty", "rule_name"])


@query
def category_level_crosstab(spark, sf):
    return cleaning.crosstab(_categorised(spark, sf))


@query
def review_summary(spark, sf):
    df = _decided(spark, sf).withColumns(
        {
            "review_status": F.when(F.col("repeat_count") % 2 == 0, "pending").otherwise("accepted"),
            "revision_need": F.col("repeat_count") == 3,
            "revision_need_type": F.when(F.col("repeat_count") == 3, "标准缺失").otherwise(""),
            "kg_match_status": F.when(F.col("repeat_count") > 4, "low_score").otherwise("matched"),
        }
    )
    return review.review_summary(df)


@query
def field_fill_rate(spark, sf):
    return quality.fill_rate(_decided(spark, sf), spread=["pred_category", "priority_label", "pred_level"])


@query
def link_validate(spark, sf):
    df = view(spark, sf, "linked_issues")
    shaped = df.select(
        F.col("kg_standard_name").alias("related_standard_name"),
        F.when(F.col("repeat_count") < 4, "").otherwise(F.col("kg_clause_title")).alias("related_clause_text"),
        F.when(F.col("repeat_count") == 6, "x")
        .when(F.col("repeat_count") == 5, "1.5")
        .otherwise(F.col("kg_relation_confidence").cast("string"))
        .alias("standard_match_confidence"),
        F.col("kg_relation_type").alias("problem_standard_relation_type"),
        "revision_need_type",
        F.when(F.col("repeat_count") == 2, "urgent").otherwise("low").alias("standard_revision_priority_initial"),
    )
    out = quality.validate_links(shaped)
    rates = ("missing_related_standard_name_rate", "missing_related_clause_text_rate")
    return out.withColumns({name: v.rounded(F.col(name), 6) for name in rates})


# ------------------------------------------------------ sorts, limits and sets


@query
def review_queue(spark, sf):
    return flags_as_text(review.review_queue(_decided(spark, sf)))


@query
def review_subset(spark, sf):
    return flags_as_text(review.review_subset(_decided(spark, sf)))


@query
def priority_top10(spark, sf):
    return flags_as_text(review.top_priority(_decided(spark, sf)))


@query
def feedback_append(spark, sf):
    base = view(spark, sf, "doc_issues").select("sample_id", "row_pos", "label")
    samples = view(spark, sf, "reviews").select("sample_id", F.col("review_no").alias("row_pos"), "reviewed_label")
    return feedback.append_feedback(base, samples, ["row_pos"])


# -------------------------------------------------------------- feedback loop


@query
def feedback_attach(spark, sf):
    df = _predictions(spark, sf).select("sample_id", "predicted_label", "confidence")
    attached = feedback.attach_review(df, "model-1", prediction_time="2024-01-01T00:00:00", threshold=0.8)
    return flags_as_text(attached)


@query
def feedback_retrain(spark, sf):
    docs = view(spark, sf, "doc_issues").select(
        "sample_id", "label", F.when(F.col("row_pos") % 2 == 0, "docs").alias("data_source")
    )
    return feedback.retrain_dataset(docs, view(spark, sf, "reviews"), ["review_no"])


# --------------------------------------------------------------- graph export


def _graph_input(spark, sf, keys=MappingProxyType({})):
    return view(spark, sf, "linked_issues", keys).withColumns(
        {
            "revision_reason": F.concat(F.lit("because \"of\" "), "predicted_severity"),
            "revision_priority_label": F.when(F.col("repeat_count") < 3, "高").otherwise("低"),
        }
    )


@query
def graph_records(spark, sf):
    return flags_as_text(graph.graph_records(_graph_input(spark, sf)).drop("graph_nodes", "graph_edges"))


@query
def graph_nested_json(spark, sf):
    return graph.with_nested_graph(_graph_input(spark, sf, LINES_BY_ORDER)).select("problem_id", "graph_nodes", "graph_edges")


@query
def graph_node_table(spark, sf):
    return graph.node_table(_graph_input(spark, sf), ["order_no", "problem_id"])


@query
def graph_edge_table(spark, sf):
    return graph.edge_table(_graph_input(spark, sf), ["order_no", "problem_id"])


# ---------------------------------------------- dataset, training, evaluation


@query
def split_stratified(spark, sf):
    docs = view(spark, sf, "doc_issues").select("row_pos", "label")
    return splits.split_stratified(docs, "label", "row_pos")


@query
def label_map(spark, sf):
    return learning.label_map(_categorised(spark, sf))


@query
def label_encode(spark, sf):
    docs = _categorised(spark, sf).select("row_pos", "data_source", "label")
    return learning.encode_labels(docs, learning.label_map(docs))


def _model_rows(spark, sf):
    built = _model_input(spark, sf).select("row_pos", "label", "model_input")
    mapping = learning.label_map(built)
    encoded = learning.encode_labels(built, mapping).withColumn("row_pos", F.col("row_pos").cast("bigint"))
    names = [row["label"] for row in mapping.orderBy("label_id").collect()]  # one row per class
    return materialise(encoded), names


@query
def train_classifier(spark, sf):
    """The model fitted on all documents: the weight of every gram for every class, and of the classes themselves."""
    rows, names = _model_rows(spark, sf)
    model = learning.train_classifier(rows, len(names))
    whole = model.weights.unionByName(model.priors.select(F.lit("").alias("gram"), F.col("priors").alias("weights")))
    return whole.select("gram", F.posexplode("weights").alias("class", "weight")).withColumn("class", F.col("class").cast("bigint"))


@query
def batch_predict(spark, sf):
    rows, names = _model_rows(spark, sf)
    model = learning.train_classifier(rows, len(names))
    found = learning.batch_predict(rows, model, names, "row_pos")
    return rows.select("row_pos", "label_text").join(found, "row_pos")


@query
def eval_metrics(spark, sf):
    return evaluation.eval_metrics(view(spark, sf, "guesses"))


@query
def eval_multilabel(spark, sf):
    df = view(spark, sf, "guesses").select(
        F.array("quality", "toxic").alias("labels"), F.array("good_logit", "toxic_logit").alias("logits")
    )
    return evaluation.eval_multilabel(df)


@query
def eval_report(spark, sf):
    return evaluation.eval_report(view(spark, sf, "guesses"))


@query
def eval_confusion(spark, sf):
    return evaluation.eval_confusion(view(spark, sf, "guesses"), ["bad", "good", "other"])
