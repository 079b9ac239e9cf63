"""Graph export: nested JSON per issue, and flat node and edge tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v
from clausewise.operators.decision import LABEL_FIELDS, confirmed_label_columns
from clausewise.session import materialise

# ---------------------------------------------------------------- fixed values
# Exported columns that are read through an alias list.

RECORD_ALIASES = {
    "feature_matrix_id": ["sample_id", "feature_matrix_id", "issue_id", "problem_id"],
    "issue_id": ["problem_id", "sample_id", "issue_id"],
    "issue_text": ["text", "issue_text", "问题描述"],
    "issue_category": ["predicted_category", "pred_category", "issue_category", "category"],
    "issue_level": ["predicted_severity", "pred_level", "issue_level", "severity"],
    "device_type": ["device_type", "设备类型"],
    "specialty": ["specialty", "监督专业", "major"],
    "problem_stage": ["problem_stage", "stage_name"],
    "kg_standard_id": ["kg_standard_id", "standard_id"],
    "kg_standard_name": ["kg_standard_name", "standard_name"],
    "kg_clause_id": ["kg_clause_id", "clause_id"],
    "kg_clause_title": ["kg_clause_title", "clause_title"],
    "kg_relation_confidence": ["kg_relation_confidence", "kg_match_score"],
}
RECORD_COLUMNS = [
    "feature_matrix_id", "issue_id", "issue_text", "issue_category", "issue_level", "device_type",
    "specialty", "supervision_stage", "problem_stage", "event_time", "source_unit", "data_source",
    "is_reviewed", "review_status", "predicted_label", "final_confirmed_label", "label_source",
    "confidence", "model_version", "prediction_time", "problem_reason", "rule_name",
    "priority_score", "priority_label", "priority_reason", "suggestion", "recommended_action",
    "kg_match_status", "kg_match_score", "kg_point_id", "kg_point_text", "kg_project", "kg_stage",
    "kg_severity", "kg_standard_refs", "kg_requirement_texts", "revision_need",
    "revision_need_type", "revision_priority_score", "revision_priority_label", "revision_reason",
    "kg_standard_id", "kg_standard_name", "kg_clause_id", "kg_clause_title", "kg_relation_type",
    "kg_relation_confidence", "graph_nodes", "graph_edges",
]
RELATION_REASONS = ["kg_relation_reason", "standard_revision_priority_reason", "revision_reason"]
TABLE_ALIASES = {
    "problem": ["graph_problem_node_id", "problem_id", "sample_id", "issue_id"],
    "text": ["问题描述", "text", "issue_text"],
    "standard": ["graph_standard_node_id", "related_standard_id", "kg_standard_id"],
    "standard_name": ["related_standard_name", "kg_standard_name", "standard_name"],
    "standard_no": ["related_standard_no", "standard_no"],
    "status": ["standard_status"],
    "clause": ["graph_clause_node_id", "related_clause_id", "kg_clause_id"],
    "clause_no": ["related_clause_no", "clause_no"],
    "clause_text": ["related_clause_text", "kg_clause_title", "clause_text"],
    "category": ["predicted_category", "pred_category", "issue_category", "预测问题类别"],
    "equipment": ["设备类型", "device_type", "equipment_type"],
    "need": ["revision_need_type"],
    "priority": ["standard_revision_priority_initial", "revision_priority_label"],
    "confidence": ["standard_match_confidence", "kg_relation_confidence", "kg_match_score"],
    "reason": ["standard_revision_trigger_evidence", "revision_reason"],
}
# ------------------------------------------------------------ end fixed values

NODE_COLUMNS = ["node_id", "node_type", "name", "standard_no", "status", "clause_no", "text"]
EDGE_COLUMNS = ["edge_id", "source_id", "target_id", "relation_type", "confidence", "relation_reason"]


#: Hexadecimal digits in the name of an issue without id.
NAME_DIGITS = 32


def _issue_labels(df: DataFrame, role: str) -> dict[str, Column]:
    """Category and level of an issue; the confirmed label stands in for the one in its role."""
    final = confirmed_label_columns(df)["final_confirmed_label"]

    def label(name: str, own: str) -> Column:
        found = v.first_of(df, RECORD_ALIASES[name])
        return F.when(found != "", found).otherwise(final) if role == own else found

    return {"issue_category": label("issue_category", "category"), "issue_level": label("issue_level", "level")}


def _node(id_: Column, kind: str, name: Column, text: Column | None = None) -> Column:
    properties = F.struct(F.nullif(text, F.lit("")).alias("text") if text is not None else F.lit(None).cast("string").alias("text"))
    return F.struct(id_.alias("id"), F.lit(kind).alias("type"), name.alias("name"), properties.alias("properties"))


def _edge(source: Column, target: Column, relation: str, field: Column, confidence: Column, reason: Column) -> Column:
    return F.struct(
        source.alias("source"),
        target.alias("target"),
        F.lit(relation).alias("relation_type"),
        confidence.alias("confidence"),
        field.alias("source_field"),
        reason.alias("relation_reason"),
    )


def _list(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


NESTED_FIELDS = [
    "issue_id", "issue_text", "device_type", "specialty", "kg_standard_id", "kg_standard_name",
    "kg_clause_id", "kg_clause_title", "kg_relation_confidence",
]
READ_FIELDS = [
    *RECORD_COLUMNS[:-2], *RELATION_REASONS, *LABEL_FIELDS,
    *[name for names in RECORD_ALIASES.values() for name in names],
]


def with_nested_graph(df: DataFrame, role: str = "level") -> DataFrame:
    """Add graph_nodes and graph_edges of each issue as JSON arrays.

    The fields they are made of come back as filled text.
    """
    columns = df.columns
    df = v.with_filled(df, READ_FIELDS)
    labels = _issue_labels(df, role)
    df = df.withColumns(
        {
            **{f"_{name}": v.first_of(df, RECORD_ALIASES[name]) for name in NESTED_FIELDS},
            "_category": labels["issue_category"],
            "_level": labels["issue_level"],
            "_reason": v.first_of(df, RELATION_REASONS),
            "_refs": v.first_of(df, ["kg_standard_refs"]),
        }
    )
    first = lambda name: F.col(f"_{name}")
    some = lambda a, b: F.when(a != "", a).otherwise(b)
    df = df.withColumn("_problem", some(first("issue_id"), v.hashed_id("problem", first("issue_text"), NAME_DIGITS)))
    blank, text, issue = F.lit(""), first("issue_text"), F.col("_problem")
    category, level, confidence = first("category"), first("level"), first("kg_relation_confidence")
    device, specialty, reason = first("device_type"), first("specialty"), first("reason")
    clause, title = first("kg_clause_id"), first("kg_clause_title")

    plain = [
        (category, "category", "has_category", "predicted_category"),
        (level, "severity", "has_severity", "predicted_severity"),
        (device, "device", "has_device", "device_type"),
        (specialty, "major", "has_major", "specialty"),
    ]
    nodes, edges = [_node(issue, "problem", issue, text)], []
    for value, kind, relation, field in plain:
        target = v.hashed_id(kind, value)
        nodes.append(F.when(value != "", _node(target, kind, value)))
        edges.append(F.when(value != "", _edge(issue, target, relation, F.lit(field), blank, blank)))
    nodes.append(F.when(clause != "", _node(clause, "clause", some(title, clause))))
    edges.append(
        F.when(clause != "", _edge(issue, clause, "related_to_clause", F.lit("kg_clause_id"), confidence, reason))
    )

    standard_id, standard_name = first("kg_standard_id"), first("kg_standard_name")
    pair = lambda id_, name, field: F.struct(id_.alias("id"), name.alias("name"), F.lit(field).alias("field"))
    own = pair(
        some(standard_id, v.hashed_id("standard", standard_name)),
        some(standard_name, standard_id),
        "kg_standard_id",
    )
    refs = F.transform(
        v.split_refs(F.col("_refs"), v.CLAUSE_REF_BREAK),
        lambda ref: pair(v.hashed_id("standard", ref), ref, "kg_standard_refs"),
    )
    pairs = F.when((standard_id != "") | (standard_name != ""), F.array(own)).otherwise(refs)
    df = df.withColumn("_pairs", pairs)
    standard_nodes = F.transform("_pairs", lambda p: _node(p["id"], "standard", p["name"]))
    standard_edges = F.flatten(
        F.transform(
            "_pairs",
            lambda p: _list(
                _edge(issue, p["id"], "related_to_standard", p["field"], confidence, reason),
                F.when(
                    clause != "",
                    _edge(clause, p["id"], "belongs_to_standard", F.lit("kg_clause_id"), confidence, reason),
                ),
            ),
        )
    )
    df = df.withColumn("_nodes", F.concat(_list(*nodes), standard_nodes))
    # A node id that comes twice keeps its first place and its last content.
    df = df.withColumn("_ids", F.array_distinct(F.col("_nodes.id")))
    last = F.transform(
        "_ids", lambda i: F.element_at(F.filter("_nodes", lambda n: n["id"] == i), -1)
    )
    unique = F.when(F.size("_ids") == F.size("_nodes"), F.col("_nodes")).otherwise(last)
    return df.select(
        *columns,
        F.to_json(unique).alias("graph_nodes"),
        F.to_json(F.concat(_list(*edges), standard_edges)).alias("graph_edges"),
    )


def graph_records(df: DataFrame, role: str = "level") -> DataFrame:
    """One row of 49 columns per issue."""
    df = with_nested_graph(df.drop("graph_nodes", "graph_edges"), role)
    own = {
        **_issue_labels(df, role),
        **confirmed_label_columns(df),
        **{name: F.col(name) for name in ("graph_nodes", "graph_edges")},
    }

    def value(name: str) -> Column:
        return own[name] if name in own else v.first_of(df, RECORD_ALIASES.get(name, [name]))

    return df.select(*[value(name).alias(name) for name in RECORD_COLUMNS])


def _prefixed(prefix: str, c: Column) -> Column:
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def _table_ids(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """What nodes and edges are made of, ids built once per issue."""
    df = df.withColumns({f"order_{i}": F.col(name) for i, name in enumerate(order_by)})
    df = v.with_filled(df, [name for names in TABLE_ALIASES.values() for name in names])
    found = df.select(
        *[f"order_{i}" for i in range(len(order_by))],
        *[v.first_of(df, names).alias(name) for name, names in TABLE_ALIASES.items()],
    )
    # an issue without id is named by its text; 128 bits, since nodes and ends of edges are told apart by the name
    problem = F.when(F.col("problem") != "", F.col("problem")).otherwise(v.hashed_id("problem", F.col("text"), NAME_DIGITS))
    some = lambda name, c: F.when(F.col(name) != "", c).otherwise("")
    found = found.withColumns(
        {
            "problem_id": _prefixed("Problem:", problem),
            "standard_id": some("standard", _prefixed("Standard:", F.col("standard"))),
            "clause_id": some("clause", _prefixed("Clause:", F.col("clause"))),
            "category_id": some("category", v.hashed_id("ProblemCategory", F.col("category"))),
            "equipment_id": some("equipment", v.hashed_id("Equipment", F.col("equipment"))),
            "need_id": some("need", v.hashed_id("RevisionNeed", F.col("need"))),
        }
    )
    priority_key = F.concat("standard_id", F.lit(":"), "priority")
    return found.withColumn(
        "priority_id",
        F.when((F.col("standard_id") != "") & (F.col("priority") != ""), v.hashed_id("RevisionPriority", priority_key)).otherwise(""),
    )


def _by_slot(ids: DataFrame, slots: Sequence[Column]) -> DataFrame:
    """The nodes or edges of all issues, each slot from a reading of its own.

    A task has the rows of one slot and sorts no more than those, and reads the columns of that slot only.
    ``tie`` is the place in which a row was written, for issues of the same order.
    """
    return _slots(materialise(ids.withColumn("tie", F.monotonically_increasing_id())), slots)


def _slots(ids: DataFrame, slots: Sequence[Column]) -> DataFrame:
    """The rows of ``_by_slot`` from issues that are written and have a ``tie`` already."""
    order = [name for name in ids.columns if name.startswith("order_")]
    parts = [ids.select(*order, "tie", F.lit(i).alias("slot"), x.alias("x")).filter("x IS NOT NULL") for i, x in enumerate(slots)]
    return reduce(DataFrame.unionByName, [part.select(*order, "slot", "tie", "x.*") for part in parts])


def _first_per(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """First row per keys in (issue order, slot, tie) order.

    Nodes such as a category occur in a large share of all rows; the rank limit
    is applied before the shuffle, so each task sends every key at most once.
    """
    order = sorted(c for c in df.columns if c.startswith("order_"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, "slot", "tie"))
    return df.withColumn("_n", first).filter("_n = 1").select(*columns)


def node_table(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Distinct nodes over all issues; the first occurrence gives the attributes."""
    ids = _table_ids(df, order_by)
    c = F.col
    none = F.lit(None).cast("string")
    optional = lambda name: F.nullif(c(name), F.lit(""))

    def node(id_: str, kind: str, name: Column, **attributes: Column) -> Column:
        content = [attributes.get(a, none).alias(a) for a in NODE_COLUMNS[3:]]
        return F.when(
            c(id_) != "",
            F.struct(c(id_).alias("node_id"), F.lit(kind).alias("node_type"), name.alias("name"), *content),
        )

    slots = [
        node("problem_id", "Problem", F.replace(c("problem_id"), F.lit("Problem:"), F.lit("")), text=optional("text")),
        node(
            "standard_id", "Standard", F.coalesce(optional("standard_name"), c("standard_id")),
            standard_no=optional("standard_no"), status=optional("status"),
        ),
        node(
            "clause_id", "Clause", F.coalesce(optional("clause_no"), c("clause_id")),
            clause_no=optional("clause_no"), text=optional("clause_text"),
        ),
        node("category_id", "ProblemCategory", c("category")),
        node("equipment_id", "Equipment", c("equipment")),
        node("need_id", "RevisionNeed", c("need")),
        node("priority_id", "RevisionPriority", c("priority")),
    ]
    return _first_per(_by_slot(ids, slots), ["node_id"], NODE_COLUMNS)


def _repeated_problems(ids: DataFrame) -> DataFrame | None:
    """Hashes of the names that more than one issue has; None if such issues are most of them.

    Of each issue 8 bytes are shuffled, and of a frequent name one row a task.
    """
    counted = materialise(ids.groupBy(F.xxhash64("problem_id").alias("hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    repeated = counted.agg(F.sum("n")).first()[0] or 0
    return counted.select("hash") if 2 * repeated <= ids.count() else None


def edge_table(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Distinct edges over all issues; edges with a blank end are dropped.

    Edges are told apart by their ends and relation, not by edge_id, which is a short hash of them. An edge that starts
    at an issue comes once if no other issue has that name, so only those of repeated names are looked through for repeats.
    """
    order = [f"order_{i}" for i in range(len(order_by))]
    needed = [f"{end}_id" for end in ("problem", "clause", "standard", "category", "equipment", "need", "priority")]
    ids = _table_ids(df, order_by).select(*order, *needed, "confidence", "reason")
    ids = materialise(ids.withColumn("tie", F.monotonically_increasing_id()), "zstd")
    c = F.col
    none = F.lit(None).cast("string")
    optional = lambda name: F.nullif(c(name), F.lit(""))

    def edge(source: str, target: str, relation: str, confidence: Column = none, reason: Column = none) -> Column:
        return F.when(
            (c(source) != "") & (c(target) != ""),
            F.struct(
                c(source).alias("source_id"),
                c(target).alias("target_id"),
                F.lit(relation).alias("relation_type"),
                confidence.alias("confidence"),
                reason.alias("relation_reason"),
            ),
        )

    of_problems = [
        edge("problem_id", "clause_id", "PROBLEM_MATCHES_CLAUSE", optional("confidence"), optional("reason")),
        edge("problem_id", "category_id", "PROBLEM_HAS_CATEGORY"),
        edge("problem_id", "equipment_id", "PROBLEM_INVOLVES_EQUIPMENT"),
        edge("problem_id", "need_id", "PROBLEM_TRIGGERS_REVISION_NEED"),
    ]
    others = [
        edge("clause_id", "standard_id", "CLAUSE_BELONGS_TO_STANDARD"),
        edge("standard_id", "priority_id", "STANDARD_HAS_REVISION_PRIORITY"),
    ]
    columns = [name for name in EDGE_COLUMNS if name != "edge_id"]
    first = lambda slots: _first_per(slots, columns[:3], columns)
    found = first(_slots(ids, others))
    repeated = _repeated_problems(ids)
    if repeated is None:
        found = found.unionByName(first(_slots(ids, of_problems)))
    else:
        same = F.xxhash64("problem_id") == c("hash")
        once, again = ids.join(repeated, same, "left_anti"), ids.join(repeated, same, "left_semi")
        found = found.unionByName(once.select(F.inline(_list(*of_problems))).select(*columns))
        found = found.unionByName(first(_slots(again, of_problems)))
    key = F.concat_ws("|", "source_id", "relation_type", "target_id")
    return found.withColumn("edge_id", v.hashed_id("Edge", key)).select(*EDGE_COLUMNS)
