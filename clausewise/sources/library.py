"""The clause dimension, from a standard library or from a property graph.

Both forms give one row per clause ("point") with the same columns, and the
list of equipment names they support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v
from clausewise.operators.stages import canonical_stage

STANDARD_FIELDS = ["standard_name", "standard_no", "standard_status", "domain", "risk_level"]
LIBRARY_SCHEMA = """
    standards array<struct<standard_id:string, standard_name:string, standard_no:string,
        standard_status:string, domain:string, equipment_type:string, risk_level:string>>,
    clauses array<struct<clause_id:string, standard_id:string, clause_no:string,
        clause_text:string, keywords:array<string>, equipment_type:string,
        problem_category:string, stage:string>>
"""
GRAPH_SCHEMA = """
    nodes array<struct<id:string, node_type:string, label:string, full_text:string,
        equipment:string, reference:string, stage:string, full_reference:string>>,
    links array<struct<source:string, target:string, edge_type:string>>,
    edges array<struct<source:string, target:string, edge_type:string>>
"""


def read_library(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Standards and clauses of a library document, each with its position."""
    document = spark.read.schema(LIBRARY_SCHEMA).json(path, multiLine=True)
    return _entries(document, "standards"), _entries(document, "clauses")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and links of a graph document, each with its position."""
    document = spark.read.schema(GRAPH_SCHEMA).json(path, multiLine=True)
    document = document.withColumn("links", F.coalesce("links", "edges"))
    return _entries(document, "nodes"), _entries(document, "links")


def _entries(document: DataFrame, name: str) -> DataFrame:
    return document.select(F.posexplode(name).alias("pos", "entry")).select("pos", "entry.*")


def _column(df: DataFrame, name: str) -> Column:
    return v.first_filled(df, [name])


def clauses_with_standard(clauses: DataFrame, standards: DataFrame) -> DataFrame:
    """Every clause with the fields of its standard; blanks where there is none."""
    last = F.struct(
        *[_column(standards, f).alias(f) for f in STANDARD_FIELDS],
        _column(standards, "equipment_type").alias("standard_equipment"),
    )
    by_id = (
        standards.select(_column(standards, "standard_id").alias("standard_id"), last.alias("s"), "pos")
        .filter("standard_id != ''")
        .groupBy("standard_id")
        .agg(F.max_by("s", "pos").alias("s"))
        .select("standard_id", "s.*")
    )
    keyed = clauses.withColumn("standard_id", _column(clauses, "standard_id"))
    joined = keyed.join(by_id, "standard_id", "left")
    return joined.na.fill("", [*STANDARD_FIELDS, "standard_equipment"])


CLAUSE_FIELDS = ["clause_id", "clause_no", "clause_text", "equipment_type", "problem_category", "stage"]


def points_from_library(standards: DataFrame, clauses: DataFrame) -> DataFrame:
    """One point per clause, in clause order (``point_pos``)."""
    df = v.with_filled(clauses_with_standard(clauses, standards), CLAUSE_FIELDS)
    df = df.withColumns({name: v.first_of(df, [name]) for name in CLAUSE_FIELDS})
    blank_to_null = lambda name: F.nullif(F.col(name), F.lit(""))
    none = F.array().cast("array<string>")
    head = v.filled(F.substring("clause_text", 1, rules.LABEL_CHARS))
    reference = F.concat_ws(" ", *[blank_to_null(n) for n in ("standard_no", "standard_name", "standard_status")])
    words = F.transform(F.coalesce(F.col("keywords"), none), v.clean)
    return df.select(
        F.coalesce(blank_to_null("clause_id"), F.concat_ws("_", "standard_id", "clause_no")).alias("point_id"),
        F.col("pos").alias("point_pos"),
        F.concat_ws(" ", blank_to_null("clause_no"), head).alias("label"),
        F.col("clause_text").alias("full_text"),
        F.coalesce(blank_to_null("equipment_type"), F.col("standard_equipment")).alias("equipment"),
        "stage",
        F.col("risk_level").alias("severity"),
        F.col("problem_category").alias("project"),
        F.array(F.coalesce(F.nullif(reference, F.lit("")), F.col("standard_id"))).alias("standards"),
        F.when(F.col("clause_text") != "", F.array("clause_text")).otherwise(none).alias("requirements"),
        "standard_id",
        "standard_name",
        "standard_no",
        "standard_status",
        "domain",
        "risk_level",
        "clause_id",
        "clause_no",
        "clause_text",
        F.filter(words, lambda word: word != "").alias("keywords"),
        "problem_category",
    )


def equipment_of_library(standards: DataFrame, clauses: DataFrame) -> DataFrame:
    """Distinct equipment names of standards and clauses."""
    both = standards.select(_column(standards, "equipment_type").alias("name")).unionByName(
        clauses.select(_column(clauses, "equipment_type").alias("name"))
    )
    return both.filter("name != ''").distinct()


def equipment_of_graph(nodes: DataFrame, equipment_node: str = rules.EQUIPMENT_NODE) -> DataFrame:
    kept = nodes.filter(F.col("node_type") == equipment_node)
    return kept.select(_column(nodes, "label").alias("name")).filter("name != ''").distinct()


def point_links(nodes: DataFrame, links: DataFrame, point_node: str = rules.POINT_NODE) -> DataFrame:
    """Typed links around points with the texts of the neighbour at the other end.

    A relation keeps the direction it is read in: HAS_POINT comes into a point,
    the other three leave it.
    """
    points = nodes.filter(F.col("node_type") == point_node).select(F.col("id").alias("point_id"))
    around = nodes.select(
        F.col("id").alias("other_id"),
        _column(nodes, "label").alias("other_label"),
        v.first_filled(nodes, ["full_reference", "label"]).alias("other_reference"),
        v.first_filled(nodes, ["full_text", "label"]).alias("other_text"),
    )
    typed = links.filter(
        F.col("edge_type").isin("HAS_POINT", "HAS_SEVERITY", "GOVERNED_BY", "HAS_REQUIREMENT")
        & (F.coalesce("source", F.lit("")) != "")
        & (F.coalesce("target", F.lit("")) != "")
    )
    incoming = F.col("edge_type") == "HAS_POINT"
    ends = typed.select(
        F.when(incoming, F.col("target")).otherwise(F.col("source")).alias("point_id"),
        F.when(incoming, F.col("source")).otherwise(F.col("target")).alias("other_id"),
        "edge_type",
        F.col("pos").alias("link_pos"),
    )
    # Ends that are no node still count: their texts are blank.
    found = ends.join(points, "point_id").join(around, "other_id", "left")
    return found.na.fill("", ["other_label", "other_reference", "other_text"])


def points_from_graph(
    nodes: DataFrame,
    links: DataFrame,
    point_node: str = rules.POINT_NODE,
    stage_aliases: dict[str, str] | None = None,
) -> DataFrame:
    """One point per point node, in node order (``point_pos``)."""
    typed = point_links(nodes, links, point_node)
    kind = F.col("edge_type")
    value = (
        F.when(kind == "GOVERNED_BY", F.col("other_reference"))
        .when(kind == "HAS_REQUIREMENT", F.col("other_text"))
        .otherwise(F.col("other_label"))
    )
    # One row per distinct neighbour value first: a point with very many links
    # reaches the second grouping with its distinct values only.
    values = (
        typed.withColumn("value", value)
        .groupBy("point_id", "edge_type", "value")
        .agg(F.min("link_pos").alias("first_pos"), F.max("link_pos").alias("last_pos"))
    )
    listed = F.struct("first_pos", "value")
    per_point = values.groupBy("point_id").agg(
        F.min_by("value", F.when(kind == "HAS_POINT", F.col("first_pos"))).alias("project"),
        F.max_by("value", F.when(kind == "HAS_SEVERITY", F.col("last_pos"))).alias("severity"),
        F.sort_array(F.collect_list(F.when(kind == "GOVERNED_BY", listed))).alias("governed"),
        F.sort_array(F.collect_list(F.when(kind == "HAS_REQUIREMENT", listed))).alias("required"),
    )
    own = nodes.filter(F.col("node_type") == point_node).withColumn("_stage", _column(nodes, "stage"))
    points = own.join(
        per_point, own["id"] == per_point["point_id"], "left"
    )
    none = F.array().cast("array<string>")
    governed = F.coalesce(F.col("governed.value"), none)
    reference = v.first_filled(nodes, ["reference"])
    standards = F.when(F.array_contains(governed, reference), governed).otherwise(
        F.concat(governed, F.array(reference))
    )
    blank = F.lit("")
    return points.select(
        F.col("id").alias("point_id"),
        F.col("pos").alias("point_pos"),
        _column(nodes, "label").alias("label"),
        v.first_filled(nodes, ["full_text", "label"]).alias("full_text"),
        _column(nodes, "equipment").alias("equipment"),
        canonical_stage(F.col("_stage"), stage_aliases).alias("stage"),
        F.coalesce("severity", blank).alias("severity"),
        F.coalesce("project", blank).alias("project"),
        F.filter(standards, lambda x: x != "").alias("standards"),
        F.filter(F.coalesce(F.col("required.value"), none), lambda x: x != "").alias("requirements"),
        *[
            blank.alias(name)
            for name in (
                "standard_id", "standard_name", "standard_no", "standard_status", "domain",
                "risk_level", "clause_id", "clause_no", "clause_text",
            )
        ],
        none.alias("keywords"),
        blank.alias("problem_category"),
    )
