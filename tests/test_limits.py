"""Cases beyond what small tables have: equal short ids, large scores, line breaks in one large file."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.operators import graph, revision
from clausewise.plans.queries import QUERIES
from clausewise.plans.views import LINES_BY_ORDER, view
from clausewise.session import COMPILED_BELOW, shared_dir
from clausewise.sources import tables


def test_edges_with_equal_short_ids(spark, monkeypatch):
    plain = v.hashed_id
    short = lambda prefix, c, digits=12: F.lit("Edge_x") if prefix == "Edge" else plain(prefix, c, digits)
    monkeypatch.setattr(v, "hashed_id", short)
    rows = [(i, f"I{i % 20}", f"kind {i % 5}", f"machine {i % 4}") for i in range(40)]
    df = spark.createDataFrame(rows, "row_pos long, issue_id string, issue_category string, device_type string")
    edges = graph.edge_table(df, ["row_pos"]).collect()
    assert {r.edge_id for r in edges} == {"Edge_x"}
    want = {(r[1], "c", r[2]) for r in rows} | {(r[1], "e", r[3]) for r in rows}
    assert len(edges) == len(want)


@pytest.mark.parametrize("score", [100.0, 150.0, 1e12, 5e20])
def test_large_scores(spark, score):
    df = spark.createDataFrame(
        [(0, "a", "GB 1", score), (1, "b", "GB 1", 0.25)], "row_pos long, sample_id string, kg_standard_refs string, priority_score double"
    )
    totals = df.groupBy().agg(v.total(F.col("priority_score")).alias("t")).first().t
    assert totals == score + 0.25
    report = revision.standard_report(df, ["row_pos"]).collect()
    assert len(report) == 1 and report[0].linked_issue_count == 2


def test_line_breaks_and_several_tasks(spark):
    texts = ["a\nb", "\\n", "\\\n", "\r\n\\\\r", 'say "x", y', " ", "plain", "\\"]
    df = spark.createDataFrame([(i, texts[i % 8] * 3) for i in range(4000)], "id long, text string").coalesce(1)
    path = tables.write_table(df, f"{shared_dir(spark)}/t.csv", escaped_breaks=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        back = tables.read_table(spark, path, df.schema, escaped_breaks=True)
        assert back.rdd.getNumPartitions() > 3
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_packed_json_lines(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 300)
    rows = [(i, None if i % 5 == 0 else "标准 \n\\ \"x\" " * 20, i / 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, a_rather_long_name string, n double").coalesce(1)
    sizes = []
    for name, codec in (("plain", None), ("packed", "lz4")):
        path = tables.write_table(df, str(tmp_path / f"{name}.jsonl"), compression=codec)
        back = tables.read_table(spark, path, df.schema)
        assert sorted(map(tuple, back.collect())) == rows
        sizes.append([x.stat().st_size for x in (tmp_path / f"{name}.jsonl").glob("part-*")])
    assert len(sizes[1]) == 4 and sum(sizes[1]) * 3 < sum(sizes[0])


def test_nodes_and_edges_by_slot(spark):
    rows = [(i // 2, f"I{i % 30}" if i % 7 else None, f"t{i % 9}", f"kind {i % 5}", f"S{i % 4}", f"name {i}", f"C{i % 6}") for i in range(200)]
    df = spark.createDataFrame(
        rows, "row_pos long, issue_id string, text string, issue_category string, kg_standard_id string, standard_name string, kg_clause_id string"
    )
    nodes = graph.node_table(df, ["row_pos", "text"])
    assert "Generate" not in nodes._jdf.queryExecution().executedPlan().toString()  # no task sorts all slots of its rows
    first = {}
    for r in sorted(rows, key=lambda r: (r[0], r[2])):
        first.setdefault(f"Standard:{r[4]}", r[5])
    found = {r.node_id: r.name for r in nodes.collect()}
    assert {k: x for k, x in found.items() if k.startswith("Standard:")} == first
    want = {("I", r[1]) if r[1] else ("t", r[2]) for r in rows} | {("c", r[3]) for r in rows} | {("C", r[6]) for r in rows}
    assert len(found) == len(want) + len(first)


def test_blanks_at_one_end(spark):
    texts = ["a", " a", "a\u3000", "\x85a", "a\x1f", "标准", "\u2003标准 ", "a 标", "a\x7f", "", " ", "none", " nan", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "n int, x string")
    got = [r.x for r in v.with_filled(df, ["x"]).orderBy("n").collect()]
    assert got == ["a", "a", "a", "a", "a", "标准", "标准", "a 标", "a\x7f", None, None, None, None, None]


def test_numbers_and_flags_by_type(spark):
    rows = [(0.25, True, 3), (float("nan"), False, None), (float("inf"), None, -1), (None, True, 0), (1e-7, False, 10**15)]
    df = spark.createDataFrame(rows, "d double, b boolean, n bigint")
    plan = df.select(v.number_of(df, "d"), v.flag_of(df, "b"), v.number_of(df, "n"))
    assert "regexp" not in plan._jdf.queryExecution().optimizedPlan().toString()
    both = df.select(v.number_of(df, "d"), v.to_number(F.col("d")), v.flag_of(df, "b"), v.is_flag(F.col("b")), v.number_of(df, "n"), v.to_number(F.col("n")))
    assert all(r[0] == r[1] and r[2] == r[3] and r[4] == r[5] for r in both.collect())


def test_huge_methods_are_left_to_compiled_operators(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    for given, kept in (("65535", COMPILED_BELOW), ("4000", 4000)):
        spark.conf.set(limit, given)
        assert QUERIES["clause_expand"](spark, "/root/testdata/sf0.001").limit(3).count() == 3
        assert int(spark.conf.get(limit)) == kept
    spark.conf.unset(limit)


def test_cleaned_texts_are_joined_runs(spark):
    texts = ["", None, " nan ", "A b-C", "v1.2.3 of 7.0, x", "设备。Abc 1.5é中", "\U0001F600a\U00020000b", "--- ", "a\nb\u3000c"]
    want = ["", "", "", "abc", "vofx", "设备abc中", "ab", "", "abc"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string")
    one = df.select("id", t.cleaned(F.col("text")).alias("clean"))
    # only dotted numbers are replaced; runs between words are many, and replacing each of them is slow
    assert one._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [r.clean for r in one.orderBy("id").collect()] == want
    assert [r.x.clean for r in t.with_tokens(df, {"x": F.col("text")}).orderBy("id").collect()] == want


@pytest.mark.parametrize("repeats", [3, 60])
def test_edges_of_issues_that_come_once_are_not_shuffled(spark, monkeypatch, repeats):
    """Only issues of repeated names are looked through for repeated edges; the first in order gives the attributes."""
    rows = [(i, f"I{i}" if i >= repeats else "", "same text", f"kind {i % 3}", f"machine {i % 2}", f"C{i % 4}", "S1", str(i)) for i in range(100)]
    rows += [(200, "I99", "again", "kind 0", "machine 1", "C9", "S1", "0.5"), (100, "I99", "again", "kind 0", "machine 0", "C9", "", "0.25")]
    df = spark.createDataFrame(
        rows, "row_pos long, issue_id string, text string, issue_category string, device_type string, kg_clause_id string, kg_standard_id string, kg_match_score string"
    )
    seen, first_per = [], graph._first_per
    monkeypatch.setattr(graph, "_first_per", lambda slots, *a: seen.append(slots.where("source_id LIKE 'Problem:%'").count()) or first_per(slots, *a))
    got = graph.edge_table(df, ["row_pos"]).collect()
    assert max(seen) == (3 * 6 if repeats == 3 else 3 * len(rows))
    want = {}
    for _, issue, text, kind, machine, clause, standard, score in sorted(rows):
        name = f"Problem:{issue}" if issue else "Problem:problem_" + hashlib.sha1(text.encode()).hexdigest()[:32]
        short = lambda prefix, x: f"{prefix}_{hashlib.sha1(x.encode()).hexdigest()[:12]}"
        want.setdefault((name, f"Clause:{clause}", "PROBLEM_MATCHES_CLAUSE"), score)
        want.setdefault((name, short("ProblemCategory", kind), "PROBLEM_HAS_CATEGORY"), None)
        want.setdefault((name, short("Equipment", machine), "PROBLEM_INVOLVES_EQUIPMENT"), None)
        if standard:
            want.setdefault((f"Clause:{clause}", f"Standard:{standard}", "CLAUSE_BELONGS_TO_STANDARD"), None)
    assert len(got) == len(want) and {(r.source_id, r.target_id, r.relation_type): r.confidence for r in got} == want
    key = lambda r: f"{r.source_id}|{r.relation_type}|{r.target_id}"
    assert all(r.edge_id == "Edge_" + hashlib.sha1(key(r).encode()).hexdigest()[:12] for r in got)


def test_order_lines_are_shuffled_once_for_their_orders(spark, tmp_path):
    """Dealing out the lines of few files does for the join, too."""
    given = {
        "lineitem": "1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 5D l_quantity, 9D l_extendedprice, 0.1D l_discount,"
        " 0D l_tax, 'R' l_returnflag, 'O' l_linestatus",
        "orders": "1L o_orderkey, 'F' o_orderstatus, '2-HIGH' o_orderpriority",
        "part": "1L p_partkey, 'bolt' p_name, 'B' p_brand, 'T' p_type, 4 p_size",
        "supplier": "1L s_suppkey, 's' s_name, 2 s_nationkey",
        "nation": "2 n_nationkey, 'N' n_name, 3 n_regionkey",
        "region": "3 r_regionkey, 'R' r_name",
    }
    for name, row in given.items():
        spark.sql(f"SELECT {row}").write.parquet(str(tmp_path / f"{name}.parquet"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        issues = view(spark, str(tmp_path), "linked_issues", LINES_BY_ORDER)
        plan = issues._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan and plan.count("hashpartitioning(l_orderkey") == 1
        assert [(r.problem_id, r.region) for r in issues.collect()] == [("I1-1-1-1-900", "R")]
    finally:
        spark.conf.set(limit, before)
