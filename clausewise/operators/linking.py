"""Linking issues to standard clauses.

The texts of both sides are prepared once, where they are; the sides meet on the equipment key, and only thin scored
rows (ids, score, reason) are shuffled, at most k of an issue from a task. The prepared clauses are written before the
join: whether they are broadcast is the planner's choice by their size (adaptive execution alone would not, as their few
equipment names leave most partitions empty), and without that adaptive execution splits the issues of a hot equipment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.operators.revision import relation_of, with_revision
from clausewise.operators.stages import canonical_stage
from clausewise.session import materialise

NAMES_IN_ROW = 1000


def blank() -> Column:
    return F.lit("")


# ------------------------------------------------------------------ equipment


def _either(parts: Sequence[str]) -> str:
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def longest_here(names: Sequence[str]) -> str:
    """Pattern of the longest of the names at a place, for ``names`` ordered longest first.

    Names are told apart by their first letter and then by their second, so that few of them are tried at a place.
    """
    plain = lambda text: "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):X}}}" for c in text)
    heads: dict[str, dict[str, list[str]]] = {}
    for name in names:
        heads.setdefault(name[0], {}).setdefault(name[1:2], []).append(plain(name[2:]))
    return _either(
        [
            # the name of one letter comes last
            plain(head) + _either([plain(second) + _either(seconds[second]) for second in sorted(seconds, reverse=True)])
            for head, seconds in heads.items()
        ]
    )


def equipment_in_row(df: DataFrame, names: Sequence[str], fields: Sequence[str]) -> Column:
    """Longest name inside the first field that holds any; null when none does.

    For a short list of names, longest first and then by name: every field is read once for the longest name at each
    of its places, without any shuffle.
    """
    if "" in names:  # every text holds it
        fields = fields[:1]
    pattern = f"(?=({longest_here([name for name in names if name])}))" if any(names) else "(?!)()"

    def found(field: str) -> Column:
        every = F.regexp_extract_all(v.clean(F.col(f"`{field}`")), F.lit(pattern), F.lit(1))
        return F.array_min(F.transform(every, lambda name: F.struct((-F.length(name)).alias("shortness"), name.alias("name"))))["name"]

    return F.coalesce(*[found(field) for field in fields], F.lit("" if "" in names else None).cast("string"))


def equipment_by_windows(
    df: DataFrame, names: DataFrame, fields: Sequence[str], id_col: str
) -> DataFrame:
    """The same for a long list of names, as an equi-join: (id, equipment).

    Every text is cut into the windows that start at each of its characters and
    are as long as the longest name.  A window and a name meet on their first
    characters (as many as the shortest name has) and the pair counts when the
    window starts with the name, so no text is compared with all names.
    """
    lengths = names.agg(F.min(F.length("name")).alias("low"), F.max(F.length("name")).alias("high"))
    bounds = lengths.first()
    low, high = bounds["low"] or 1, bounds["high"] or 1
    texts = F.array(*[v.clean(F.col(f"`{field}`")) for field in fields])
    cut = f"(?s)(?=(.{{{low},{high}}}))"
    windows = (
        df.select(id_col, F.posexplode(texts).alias("field_no", "text"))
        .select(id_col, "field_no", F.array_distinct(F.regexp_extract_all("text", F.lit(cut), F.lit(1))).alias("w"))
        .select(id_col, "field_no", F.explode("w").alias("window"))
        .withColumn("anchor", F.substring("window", 1, low))
    )
    anchored = names.select("name", F.substring("name", 1, low).alias("anchor"))
    hits = windows.join(anchored, "anchor").filter(F.col("window").startswith(F.col("name")))
    best = F.min(F.struct("field_no", (-F.length("name")).alias("shortness"), "name"))
    return hits.groupBy(id_col).agg(best.alias("best")).select(id_col, F.col("best.name").alias("equipment"))


def with_equipment(
    issues: DataFrame,
    names: DataFrame,
    id_col: str,
    *,
    fields: Sequence[str] = tuple(rules.EQUIPMENT_FIELDS),
    in_row: int = NAMES_IN_ROW,
) -> DataFrame:
    """Issues with the supported ``equipment`` they name ('' when none)."""
    fields = [name for name in fields if name in issues.columns]
    few = names.limit(in_row + 1).collect()
    if not few or not fields:
        return issues.withColumn("equipment", blank())
    if len(few) <= in_row:
        ordered = sorted((row["name"] for row in few), key=lambda name: (-len(name), name))
        found = equipment_in_row(issues, ordered, fields)
        return issues.withColumn("equipment", F.coalesce(found, blank()))
    found = equipment_by_windows(issues, names, fields, id_col)
    return issues.join(found, id_col, "left").na.fill("", ["equipment"])


# ------------------------------------------------------- features of each side


def issue_features(
    issues: DataFrame, id_col: str, stage_aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """What the score needs of an issue, texts prepared.  ``equipment`` must be there."""
    names = rules.LINK_ALIASES
    used = [*names["text"], *names["category"], *names["stage"], *names["level"], *rules.OPINION_FIELDS]
    filled = v.with_filled(issues, [*used, "checkpoint_text", "rule_name"])
    read = filled.select(
        id_col,
        "equipment",
        v.first_of(filled, names["text"]).alias("issue_text"),
        v.first_of(filled, names["category"]).alias("category"),
        v.first_of(filled, ["checkpoint_text"]).alias("_checkpoint"),
        v.joined_of(filled, rules.OPINION_FIELDS).alias("_opinion"),
        v.first_of(filled, ["rule_name"]).alias("_rule"),
        v.first_of(filled, names["stage"]).alias("_stage"),
        v.first_of(filled, names["level"]).alias("level"),
    )
    texts = {
        "issue": F.col("issue_text"),
        "checkpoint": F.col("_checkpoint"),
        "opinion": F.col("_opinion"),
        "rule": F.col("_rule"),
        "category_tokens": F.col("category"),
    }
    stage = canonical_stage(F.col("_stage"), stage_aliases)
    return t.with_tokens(read.withColumn("stage", stage), texts).drop("_checkpoint", "_opinion", "_rule", "_stage")


def point_features(points: DataFrame) -> DataFrame:
    """What the score needs of a clause, texts prepared."""
    listed = {name: F.concat_ws(" ", F.col(name)) for name in ("keywords", "standards", "requirements")}
    order = [
        "label", "full_text", "project", "stage", "severity", "standard_name", "standard_no",
        "standard_status", "clause_no", "clause_text", "keywords", "problem_category", "standards",
        "requirements",
    ]
    parts = [F.nullif(listed.get(name, F.col(name)), blank()) for name in order]
    own = F.concat(F.col("full_text"), F.lit(" "), listed["requirements"])
    texts = {
        "point_all": F.concat_ws(" ", *parts),
        "point_own": own,
        "point_standards": listed["standards"],
        "point_category_tokens": F.col("problem_category"),
    }
    return t.with_tokens(points, texts).select(
        "point_id",
        "point_pos",
        "equipment",
        *texts,
        F.col("keywords").alias("point_keywords"),
        F.col("problem_category").alias("point_category"),
        F.col("stage").alias("point_stage"),
        F.col("severity").alias("point_severity"),
        (F.col("clause_id") != "").alias("has_clause"),
    )


def by_equipment(issues: DataFrame, points: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the key on which they meet: the equipment, or one key for all when there are no names.

    Issues without a supported equipment have no candidates and are left out, as long as there are names.
    """
    any_name = names.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    key = lambda df: df.withColumn("equipment", F.when(any_name, F.col("equipment")).otherwise(""))
    return key(issues.where((F.col("equipment") != "") | ~any_name)), key(points)


def candidates(issues: DataFrame, points: DataFrame, names: DataFrame, id_col: str) -> DataFrame:
    """(id, equipment, point_id) of every issue and each clause it is compared with."""
    left, right = by_equipment(issues.select(id_col, "equipment"), points.select("equipment", "point_id"), names)
    return left.join(right, "equipment").select(id_col, "equipment", "point_id")


# ---------------------------------------------------------------------- score


def scored(pairs: DataFrame, match_rules: Mapping = rules.MATCH_RULES) -> DataFrame:
    """Pairs with their part scores, hits, total score and reason."""
    w = match_rules["weights"]
    c = F.col
    same_category = (c("category") != "") & (c("category") == c("point_category"))
    alike = lambda left, right: t.similarity(c(left), c(right), match_rules)
    parts = pairs.withColumns(
        {
            "checkpoint_score": alike("checkpoint", "point_own"),
            "issue_score": alike("issue", "point_all"),
            "opinion_score": alike("opinion", "point_all"),
            "rule_score": alike("rule", "point_standards"),
            "category_score": F.when(same_category, 1.0).otherwise(alike("category_tokens", "point_category_tokens")),
            "stage_score": F.when((c("stage") != "") & (c("stage") == c("point_stage")), 1.0).otherwise(0.0),
            "severity_score": F.when((c("level") != "") & (c("level") == c("point_severity")), 1.0).otherwise(0.0),
            "keyword_hits": t.keyword_hits(c("point_keywords"), c("issue_text")),
            "keywords_listed": F.size("point_keywords"),
            "checkpoint_hit": (c("checkpoint.clean") != "")
            & c("point_own.clean").contains(c("checkpoint.clean")),
        }
    )
    keyword_score = F.when(c("keywords_listed") > 0, c("keyword_hits") / c("keywords_listed")).otherwise(0.0)
    parts = parts.withColumn("keyword_score", keyword_score)
    total = (
        w["checkpoint"] * c("checkpoint_score")
        + w["issue"] * c("issue_score")
        + w["keywords"] * c("keyword_score")
        + w["category"] * c("category_score")
        + w["opinion"] * c("opinion_score")
        + w["rule"] * c("rule_score")
        + w["stage"] * c("stage_score")
        + w["severity"] * c("severity_score")
    )
    exact_floor = F.when(c("checkpoint_hit"), float(match_rules["checkpoint_floor"])).otherwise(0.0)
    keyword_floor = F.when(
        c("has_clause")
        & (c("keyword_hits") > 0)
        & (c("category_score") >= match_rules["keyword_floor_category"]),
        F.least(
            match_rules["keyword_floor_base"] + match_rules["keyword_floor_step"] * c("keyword_hits"),
            F.lit(float(match_rules["keyword_floor_top"])),
        ),
    ).otherwise(0.0)
    best = F.least(F.lit(1.0), F.greatest(total, exact_floor, keyword_floor))
    return parts.withColumn("score", v.rounded(best, 4))


def reason_of(match_rules: Mapping = rules.MATCH_RULES) -> Column:
    """The part scores of a match in words."""
    shown = [("checkpoint", 2), ("issue", 2), ("keyword", 2), ("category", 2), ("stage", 0), ("severity", 0)]
    label = {"keyword": "keywords"}
    return F.concat_ws(
        "; ",
        F.when(F.col("checkpoint_hit"), match_rules["checkpoint_reason"]),
        *[
            F.concat(F.lit(f"{label.get(name, name)}="), v.fixed(F.col(f"{name}_score"), digits))
            for name, digits in shown
        ],
    )


def match_scores(
    issues: DataFrame,
    points: DataFrame,
    names: DataFrame,
    id_col: str,
    *,
    match_rules: Mapping = rules.MATCH_RULES,
    stage_aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Pairs of issues and clauses of their equipment with their part scores; thin rows without the texts."""
    left, right = by_equipment(issues, points, names)
    # written first, so that the planner knows the size: with few clauses no text of an issue is shuffled or sorted
    pairs = issue_features(left, id_col, stage_aliases).join(materialise(point_features(right)), "equipment")
    return scored(pairs, match_rules).select(
        id_col, "point_id", "point_pos", "checkpoint_score", "issue_score", "keyword_score",
        "category_score", "opinion_score", "rule_score", "stage_score", "severity_score",
        "keyword_hits", "checkpoint_hit", "score",
    )


def best_matches(
    scores: DataFrame,
    id_col: str,
    top_k: int = rules.TOP_K,
    min_score: float = rules.MIN_SCORE,
    match_rules: Mapping = rules.MATCH_RULES,
) -> DataFrame:
    """The k best clauses of each issue, ties by clause order, ranked from 1.

    Tasks drop all but the k best of an issue before the shuffle, which is of thin rows.
    """
    order = Window.partitionBy(id_col).orderBy(F.desc("score"), "point_pos", "point_id")
    ranked = scores.filter(F.col("score") >= min_score).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top_k).withColumn("reason", reason_of(match_rules))


@dataclass(frozen=True)
class Links:
    """(id, ``equipment``) of all issues, their ranked matches, and the clauses and names they were matched with."""

    found: DataFrame
    matches: DataFrame
    id_col: str
    points: DataFrame
    names: DataFrame


def link(
    issues: DataFrame,
    points: DataFrame,
    names: DataFrame,
    id_col: str,
    *,
    top_k: int = rules.TOP_K,
    min_score: float = rules.MIN_SCORE,
    match_rules: Mapping = rules.MATCH_RULES,
    stage_aliases: Mapping[str, str] | None = None,
) -> Links:
    """Find the equipment of every issue and its best clauses."""
    named = with_equipment(issues, names, id_col)
    scores = match_scores(named, points, names, id_col, match_rules=match_rules, stage_aliases=stage_aliases)
    matches = best_matches(scores, id_col, top_k, min_score, match_rules)
    return Links(named.select(id_col, "equipment"), matches, id_col, points, names)


def with_status(links: Links) -> DataFrame:
    """Ids with the best match, if any, and why an issue has or lacks one."""
    some = lambda df: df.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    best = links.matches.filter("rank = 1").select(links.id_col, "point_id", "score", "reason")
    status = (
        F.when(~some(links.points), "no_kg_data")
        .when(F.col("score").isNotNull(), "matched")
        .when((F.col("equipment") == "") & some(links.names), "unsupported_equipment")
        .otherwise("low_score")
    )
    return links.found.join(best, links.id_col, "left").withColumn("kg_match_status", status)


def nested_matches(links: Links, points: DataFrame) -> DataFrame:
    """The k matches of each issue as one JSON array in rank order."""
    shown = points.select("point_id", "full_text", "project", "stage", "standards")
    entry = F.struct(
        "rank",
        F.struct(
            F.col("point_id").alias("kg_point_id"),
            "score",
            F.col("full_text").alias("kg_point_text"),
            F.col("project").alias("kg_project"),
            F.col("stage").alias("kg_stage"),
            F.col("standards").alias("kg_standard_refs"),
        ).alias("match"),
    )
    thin = links.matches.select(links.id_col, "point_id", "rank", "score")
    listed = thin.join(shown, "point_id")
    grouped = listed.groupBy(links.id_col).agg(F.sort_array(F.collect_list(entry)).alias("m"))
    return grouped.select(links.id_col, F.to_json(F.col("m.match")).alias("kg_top_matches"))


def enrich_issues(
    issues: DataFrame,
    points: DataFrame,
    names: DataFrame,
    order_col: str,
    *,
    top_k: int = rules.TOP_K,
    min_score: float = rules.MIN_SCORE,
    match_rules: Mapping = rules.MATCH_RULES,
    revision_rules: Sequence[Mapping] = tuple(rules.REVISION_RULES),
    stage_aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Issues with their best clause (31 columns) and the revision outcome (5 columns).

    ``order_col`` is the place of an issue, counted from 0 (``tables.with_position``); an issue without an id is
    named by it, counted from 1.
    """
    links = link(
        issues, points, names, order_col, top_k=top_k, min_score=min_score, match_rules=match_rules, stage_aliases=stage_aliases
    )
    # the thin matches are read for the best one and for the list: scored once
    links = replace(links, matches=materialise(links.matches))
    best = with_status(links).join(nested_matches(links, points), order_col, "left")
    # Points under names of their own, to stay apart from the issue's columns.
    named = points.select(*[F.col(c).alias(f"p_{c}") for c in points.columns])
    best = best.withColumnRenamed("point_id", "p_point_id").join(named, "p_point_id", "left")
    full = issues.join(best.drop("equipment"), order_col)

    p = lambda name: F.col(f"p_{name}")
    text = lambda c: F.coalesce(c, blank())
    standard = F.get(p("standards"), F.lit(0))
    own = lambda name: F.nullif(p(name), blank())
    fallback = F.concat(F.lit("problem_"), (F.col(order_col) + 1).cast("string"))
    full = v.with_filled(full, rules.LINK_ALIASES["issue_id"], prefix="_f_")
    full = full.withColumns(
        {
            "_issue": F.coalesce(F.nullif(v.first_of(full, rules.LINK_ALIASES["issue_id"], prefix="_f_"), blank()), fallback),
            "_standard": F.coalesce(own("standard_id"), standard, blank()),
            "_standard_name": F.coalesce(own("standard_name"), standard, blank()),
            "_clause": F.coalesce(own("clause_id"), p("point_id"), blank()),
            "_clause_text": F.coalesce(own("clause_text"), p("full_text"), blank()),
            "_score": F.coalesce("score", F.lit(0.0)),
        }
    )
    issue_id, standard_id, standard_name = F.col("_issue"), F.col("_standard"), F.col("_standard_name")
    clause_id, clause_text, score = F.col("_clause"), F.col("_clause_text"), F.col("_score")
    matched = F.col("kg_match_status") == "matched"
    evidence = F.concat_ws(" ", p("standards"), p("requirements"))
    full = full.drop("revision_need", "revision_need_type", "revision_priority_score")
    full = full.drop("revision_priority_label", "revision_reason")
    full = with_revision(full, matched, p("standard_status"), evidence, score, revision_rules)
    relation = relation_of(matched, F.col("revision_need_type"), p("standard_status"))
    cut = rules.REVISION_PRIORITY_RULES["label_thresholds"]
    priority = (
        F.when(F.col("revision_priority_score") >= cut["high"], "high")
        .when(F.col("revision_priority_score") >= cut["medium"], "medium")
        .otherwise("low")
    )
    added = {
        "problem_id": issue_id,
        "kg_match_status": F.col("kg_match_status"),
        "kg_match_score": score,
        "kg_point_id": text(p("point_id")),
        "kg_point_text": text(p("full_text")),
        "kg_project": text(p("project")),
        "kg_stage": text(p("stage")),
        "kg_severity": text(p("severity")),
        "kg_standard_refs": text(F.concat_ws("；", p("standards"))),
        "kg_requirement_texts": text(F.concat_ws(" || ", p("requirements"))),
        "kg_top_matches": F.coalesce("kg_top_matches", F.lit("[]")),
        "related_standard_id": standard_id,
        "related_standard_name": standard_name,
        "related_standard_no": text(p("standard_no")),
        "related_clause_id": clause_id,
        "related_clause_no": text(p("clause_no")),
        "related_clause_text": clause_text,
        "standard_match_confidence": score,
        "problem_standard_relation_type": relation,
        "standard_status": text(p("standard_status")),
        "standard_revision_trigger_evidence": F.col("revision_reason"),
        "standard_revision_priority_initial": priority,
        "graph_problem_node_id": v.node_id("Problem", issue_id),
        "graph_standard_node_id": v.node_id("Standard", standard_id),
        "graph_clause_node_id": v.node_id("Clause", clause_id),
        "graph_relation_type": F.when(matched, "PROBLEM_MATCHES_CLAUSE").otherwise("UNMATCHED"),
        "kg_standard_id": standard_id,
        "kg_standard_name": standard_name,
        "kg_clause_id": clause_id,
        "kg_clause_title": F.coalesce(
            own("clause_no"), F.substring(clause_text, 1, rules.TITLE_CHARS)
        ),
        "kg_relation_type": relation,
        "kg_relation_confidence": score,
        **{
            name: F.col(name)
            for name in (
                "revision_need", "revision_need_type", "revision_priority_score",
                "revision_priority_label", "revision_reason",
            )
        },
    }
    kept = [F.col(f"`{c}`") for c in issues.columns if c not in added]
    return full.select(*kept, *[column.alias(name) for name, column in added.items()])
