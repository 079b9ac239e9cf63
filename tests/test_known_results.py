"""Whole chain on the small inputs, against known results."""

import json

import pytest
from pyspark.sql import functions as F

from clausewise.operators import graph, linking, ranking, revision
from clausewise.sources import library
from tests import fixtures as fx


@pytest.fixture(scope="module")
def enriched(spark):
    standards = spark.createDataFrame(fx.STANDARDS, fx.STANDARD_SCHEMA).withColumn("pos", F.monotonically_increasing_id())
    clauses = spark.createDataFrame([(i, *c) for i, c in enumerate(fx.CLAUSES)], "pos int, " + fx.CLAUSE_SCHEMA)
    issues = spark.createDataFrame(fx.ISSUES, fx.ISSUE_SCHEMA)
    out = linking.enrich_issues(
        issues,
        library.points_from_library(standards, clauses),
        library.equipment_of_library(standards, clauses),
        "row_pos",
        min_score=0.12,
    )
    return out.cache()


def column(df, name, order="row_pos"):
    return [row[name] for row in df.orderBy(order).collect()]


def test_matches_and_needs(enriched):
    assert column(enriched, "kg_match_score") == fx.MATCH_SCORES
    assert column(enriched, "revision_need_type") == fx.NEEDS
    assert column(enriched, "revision_priority_score") == fx.PRIORITIES
    assert set(column(enriched, "kg_match_status")) == {"matched"}
    first = enriched.filter("problem_id = 'SP-001'").first()
    assert first["kg_standard_refs"] == "Q/GDW-SAMPLE-001 组合电器安装与接地监督标准 现行"
    assert first["graph_clause_node_id"] == "Clause:CLAUSE-GIS-001"
    assert first["kg_clause_title"] == "4.3.10"
    assert first["standard_revision_priority_initial"] == "low"
    assert first["problem_standard_relation_type"] == "standard_execution"
    assert first["revision_reason"].startswith(
        "问题更偏向标准或监督要求执行不到位，优先纳入整改闭环。 关联标准依据：Q/GDW-SAMPLE-001"
    )
    assert [m["kg_point_id"] for m in json.loads(first["kg_top_matches"])] == ["CLAUSE-GIS-001"]
    assert len(enriched.columns) - len(fx.ISSUES[0]) == 36


def test_ranking_of_enriched(enriched):
    ranked = ranking.rank(ranking.expand(enriched, ["row_pos"])).collect()
    assert [r["aggregated_priority_score"] for r in ranked] == fx.CLAUSE_SCORES
    top = ranked[0]
    assert top["kg_clause_id"] == "CLAUSE-SAFE-001" and top["rank"] == 1
    assert top["aggregated_priority_reason"] == (
        "该标准/条款当前关联问题数量较少，高严重问题占比较高，存在标准制修订需求，图谱关联置信度较高，建议优先纳入标准修订需求池。"
    )
    assert json.loads(top["relation_type_distribution"]) == {"standard_lagging": 1}
    assert len(top.asDict()) == 37


def test_tables_of_enriched(enriched):
    nodes = graph.node_table(enriched, ["row_pos"]).collect()
    edges = graph.edge_table(enriched, ["row_pos"]).collect()
    kinds = {}
    for node in nodes:
        kinds[node["node_type"]] = kinds.get(node["node_type"], 0) + 1
    assert kinds == {
        "Problem": 10, "Clause": 8, "Standard": 4, "Equipment": 4, "ProblemCategory": 4,
        "RevisionNeed": 5, "RevisionPriority": 5,
    }
    relations = {}
    for edge in edges:
        relations[edge["relation_type"]] = relations.get(edge["relation_type"], 0) + 1
    assert relations == {
        "PROBLEM_MATCHES_CLAUSE": 10, "PROBLEM_HAS_CATEGORY": 10, "PROBLEM_INVOLVES_EQUIPMENT": 10,
        "PROBLEM_TRIGGERS_REVISION_NEED": 10, "CLAUSE_BELONGS_TO_STANDARD": 8,
        "STANDARD_HAS_REVISION_PRIORITY": 5,
    }
    ids = {node["node_id"] for node in nodes}
    assert {e["source_id"] for e in edges} | {e["target_id"] for e in edges} <= ids
    assert len({e["edge_id"] for e in edges}) == len(edges)
    assert {"ProblemCategory_77160097e82d", "Equipment_b8b96da032b8", "RevisionNeed_77678a4b7941", "RevisionPriority_50106b2b9323"} <= ids
    assert {"Edge_0a3405b311be", "Edge_60772ed11190", "Edge_57adab6575d2"} <= {e["edge_id"] for e in edges}


def test_ranking_of_linked(spark):
    df = spark.createDataFrame(fx.LINKED, fx.LINKED_SCHEMA)
    expanded = ranking.expand(df, ["row_pos"])
    ranked = ranking.rank(expanded).collect()
    assert [r["aggregated_priority_score"] for r in ranked] == [75.32, 56.13, 17.53]
    top = ranked[0]
    assert (top["related_problem_count"], top["revision_demand_count"], top["manual_review_count"], top["low_confidence_problem_count"]) == (4, 4, 1, 1)
    assert top["representative_problem_ids"] == "D001；D003；D002"
    assert top["avg_relation_confidence"] == 0.7625
    assert ranked[1]["clause_missing"] and ranked[1]["kg_clause_id"] == ""
    total = ranking.summary(ranking.fold(expanded)).first()
    assert tuple(total) == (6, 3, 3, 2, 0, 1, 1, 1)


def test_report_per_standard(enriched):
    report = revision.standard_report(enriched.withColumnRenamed("problem_id", "sample_id"), ["row_pos"]).collect()
    assert len(report) == 4
    assert {r["linked_issue_count"] for r in report} == {2, 3}
    assert all(r["standard_revision_priority_label"] in ("高", "中", "低") for r in report)
    scores = [r["standard_revision_priority_score"] for r in report]
    assert scores == sorted(scores, reverse=True)
