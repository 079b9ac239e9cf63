"""Clause sources and linking: other forms, fallbacks, skew."""

import json

import pytest
from pyspark.sql import functions as F

from clausewise.operators import graph, linking
from clausewise.sources import library, tables
from tests import fixtures as fx

NODES = [
    {"id": "E1", "node_type": "设备类型", "label": "组合电器"},
    {"id": "PROJECT", "node_type": "监督项目", "label": "接地检查"},
    {"id": "point_1", "node_type": "监督要点", "label": "接地线与GIS接地母线应采用螺栓连接方式。",
     "full_text": "接地线与GIS接地母线应采用螺栓连接方式。", "equipment": "组合电器",
     "reference": "《接地装置施工及验收规范》（GB 50169-2016）4.3.10。", "stage": "工程设计"},
    {"id": "S", "node_type": "问题分级", "label": "一般"},
    {"id": "STD", "node_type": "标准文件", "label": "规范", "full_reference": "《接地装置施工及验收规范》（GB 50169-2016）"},
    {"id": "REQ", "node_type": "监督要求", "label": "x", "full_text": "接地线与GIS接地母线应采用螺栓连接方式。"},
]
LINKS = [
    {"source": "PROJECT", "target": "point_1", "edge_type": "HAS_POINT"},
    {"source": "point_1", "target": "S", "edge_type": "HAS_SEVERITY"},
    {"source": "point_1", "target": "STD", "edge_type": "GOVERNED_BY"},
    {"source": "point_1", "target": "REQ", "edge_type": "HAS_REQUIREMENT"},
]


@pytest.fixture(scope="module", params=["links", "edges"])
def graph_library(request, spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("graph") / "graph.json"
    path.write_text(json.dumps({"nodes": NODES, request.param: LINKS}, ensure_ascii=False), encoding="utf-8")
    nodes, links = library.read_graph(spark, str(path))
    return library.points_from_graph(nodes, links), library.equipment_of_graph(nodes)


def test_points_of_a_graph(graph_library):
    points, names = graph_library
    assert [r["name"] for r in names.collect()] == ["组合电器"]
    (point,) = points.collect()
    assert (point["severity"], point["project"], point["stage"]) == ("一般", "接地检查", "工程设计")
    assert len(point["standards"]) == 2 and "GB 50169" in point["standards"][0]


def test_known_checkpoint_and_unsupported_equipment(spark, graph_library):
    issues = spark.createDataFrame(
        [(1, "组合电器", "工程设计", "一般", "3.6.2 接地线与 GIS接地母线应采用螺栓连接方式。", "GIS接地线无法与汇流接地母线用螺栓紧固。"),
         (2, "运行杆塔", None, None, None, "螺栓错位")],
        "n int, device_type string, stage_name string, rule_level string, checkpoint_text string, text string",
    )
    rows = linking.enrich_issues(issues, *graph_library, "n").orderBy("n").collect()
    assert (rows[0]["kg_match_status"], rows[0]["kg_point_id"]) == ("matched", "point_1")
    assert rows[0]["kg_match_score"] > 0.8
    assert (rows[1]["kg_match_status"], rows[1]["kg_point_id"], rows[1]["kg_relation_type"]) == (
        "unsupported_equipment", "", "unmatched",
    )


def test_empty_library(spark):
    standards = spark.createDataFrame([], "pos int, " + fx.STANDARD_SCHEMA)
    clauses = spark.createDataFrame([], "pos int, " + fx.CLAUSE_SCHEMA)
    issues = spark.createDataFrame(fx.ISSUES[:1], fx.ISSUE_SCHEMA)
    row = linking.enrich_issues(
        issues, library.points_from_library(standards, clauses), library.equipment_of_library(standards, clauses), "row_pos"
    ).first()
    assert (row["kg_match_status"], row["kg_standard_id"], row["kg_relation_type"], row["kg_top_matches"]) == (
        "no_kg_data", "", "unmatched", "[]",
    )


def test_equipment_paths_agree_with_brute_force(spark):
    names = ["src1", "src12", "变压器", "主变压器", "abcabc", "z"]
    rows = [
        (1, "src12 unit", "变压器"), (2, "", "xx 主变压器 src1"), (3, None, "none"), (4, "nan", "aabcabcb"),
        (5, "a", "src"), (6, "src1src12", ""), (7, "", "end z"), (8, "变压", "器z" * 50),
    ]
    df = spark.createDataFrame(rows, "n int, device_type string, text string")
    table = spark.createDataFrame([(x,) for x in names], "name string")

    def brute(row):
        for value in row[1:]:
            value = "" if value is None or value.lower() == "nan" else value
            found = sorted((x for x in names if x in value), key=lambda x: (-len(x), x))
            if found:
                return found[0]
        return ""

    expected = {row[0]: brute(row) for row in rows}
    for in_row in (1000, 0):
        out = linking.with_equipment(df, table, "n", in_row=in_row)
        assert {r["n"]: r["equipment"] for r in out.collect()} == expected


def test_candidates_are_all_pairs(spark):
    issues = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "")], "row_pos long, equipment string")
    points = spark.createDataFrame([("p", "a"), ("q", "a"), ("r", "c")], "point_id string, equipment string")
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    found = linking.candidates(issues, points, names, "row_pos")
    assert sorted(map(tuple, found.collect())) == [(1, "a", x) for x in "ppqq"]
    every = linking.candidates(issues, points, names.limit(0), "row_pos")
    assert every.count() == 4 * 3


def test_linking_without_broadcast(spark):
    standards = spark.createDataFrame([(i, *s) for i, s in enumerate(fx.STANDARDS)], "pos int, " + fx.STANDARD_SCHEMA)
    clauses = spark.createDataFrame([(i, *c) for i, c in enumerate(fx.CLAUSES)], "pos int, " + fx.CLAUSE_SCHEMA)
    issues = spark.createDataFrame(fx.ISSUES, fx.ISSUE_SCHEMA)
    points = library.points_from_library(standards, clauses)
    no_names = spark.createDataFrame([], "name string")
    size = "spark.sql.autoBroadcastJoinThreshold"
    for names, low in ((library.equipment_of_library(standards, clauses), 0.12), (no_names, 0.0)):
        found = []
        for limit in ("10m", "-1"):
            spark.conf.set(size, limit)
            matches = linking.link(issues, points, names, "row_pos", min_score=low).matches
            found.append(sorted((r["row_pos"], r["point_id"], r["score"], r["rank"]) for r in matches.collect()))
        spark.conf.unset(size)
        assert found[0] == found[1] and found[0]
    # Without any equipment every clause is a candidate.
    assert len(found[0]) == 3 * len(fx.ISSUES)


def test_ids_of_issues_without_one(spark, tmp_path):
    path = str(tmp_path / "issues")
    spark.range(0, 5, 1, 3).selectExpr("concat('text ', id) AS text", "CASE WHEN id = 2 THEN 'own' END AS problem_id").write.json(path)
    placed = tables.with_position(spark.read.schema("text string, problem_id string").json(path))
    assert sorted(r["row_pos"] for r in placed.collect()) == list(range(5))
    standards = spark.createDataFrame([], "pos int, " + fx.STANDARD_SCHEMA)
    clauses = spark.createDataFrame([], "pos int, " + fx.CLAUSE_SCHEMA)
    points, names = library.points_from_library(standards, clauses), library.equipment_of_library(standards, clauses)
    rows = linking.enrich_issues(placed, points, names, "row_pos").collect()
    assert {r["row_pos"]: r["problem_id"] for r in rows} == {
        r["row_pos"]: "own" if r["text"] == "text 2" else f"problem_{r['row_pos'] + 1}" for r in rows
    }


def test_nested_graph(spark):
    df = spark.createDataFrame(
        [("P1", "文本", "组合电器", "电气", "施工", "重大", "S1", "标准一", "C1", "条款"), ("P2", "文本", "组合电器", "电气", "施工", "重大", "S1", "标准一", "", "")],
        "problem_id string, text string, device_type string, specialty string, predicted_category string, predicted_severity string, "
        "kg_standard_id string, kg_standard_name string, kg_clause_id string, kg_clause_title string",
    )
    rows = {r["issue_id"]: r for r in graph.graph_records(df).collect()}
    assert len(rows["P1"].asDict()) == 49
    kinds = {i: [e["relation_type"] for e in json.loads(r["graph_edges"])] for i, r in rows.items()}
    assert kinds["P1"][-3:] == ["related_to_clause", "related_to_standard", "belongs_to_standard"]
    assert kinds["P2"][-1] == "related_to_standard" and "related_to_clause" not in kinds["P2"]
    assert {n["type"] for n in json.loads(rows["P2"]["graph_nodes"])} == {"problem", "category", "severity", "device", "major", "standard"}


def test_names_in_a_row_are_found_in_one_reading(spark):
    names = ["a", "a.c", "a.cd", "(x", "(x)", "设备", "😀b", "ab" * 40, "b|", "q\\E"]
    texts = ["a", "abc", "za.cde (x", "(x) (x", "a设备", "😀b a", "ab" * 41, "b|a.c", "q\\E\\Q", "", None, "nan", "xx\n设备\na", "b(xa.c"]
    ordered = sorted(names, key=lambda name: (-len(name), name))
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "n int, text string")
    column = linking.equipment_in_row(df, ordered, ["text"])
    found = [r["e"] for r in df.select("n", column.alias("e")).orderBy("n").collect()]
    empty = ("", "nan")
    assert found == [next((x for x in ordered if x in (t or "") and t not in empty), None) for t in texts]
    plan = df.select(column)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan.lower()  # no text is looked through once for every name
    assert df.select(linking.equipment_in_row(df, ["b", ""], ["text"]).alias("e")).where("e = ''").count() == 9


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _linked_fixture(spark):
    standards = spark.createDataFrame([(i, *s) for i, s in enumerate(fx.STANDARDS)], "pos int, " + fx.STANDARD_SCHEMA)
    clauses = spark.createDataFrame([(i, *c) for i, c in enumerate(fx.CLAUSES)], "pos int, " + fx.CLAUSE_SCHEMA)
    names = library.equipment_of_library(standards, clauses)
    return spark.createDataFrame(fx.ISSUES, fx.ISSUE_SCHEMA), library.points_from_library(standards, clauses), names


def test_enriched_issues_are_scored_once(spark):
    out = linking.enrich_issues(*_linked_fixture(spark), "row_pos")
    assert "array_intersect" not in _plan(out)  # the matches are read, not worked out for the best one and for the list
    assert [r["kg_match_score"] > 0 for r in out.collect()] == [True] * len(fx.ISSUES)


def test_clauses_are_prepared_before_the_join(spark):
    matches = linking.link(*_linked_fixture(spark), "row_pos").matches
    plan = _plan(matches)
    assert "array_intersect" in plan and "point_all_low" not in plan  # so that their size is known
    assert matches.where("rank = 1").count() == len(fx.ISSUES)
