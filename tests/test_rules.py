"""Worked values of the small rules."""

import pytest
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.operators import cleaning, decision, evaluation, feedback, numbering, ranking, review, revision
from clausewise.operators.stages import canonical_stage


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_shares_and_severity(spark):
    assert one(spark, *[v.to_share(F.lit(x)) for x in ("85%", "85", "0.85", "x", "250")]) == (0.85, 0.85, 0.85, 0.0, 1.0)
    assert one(spark, *[v.severity_rank(F.lit(x)) for x in ("重大", "较大", "一般", "中高", "")]) == (3, 2, 1, 3, 0)
    assert one(spark, *[v.is_demand(F.lower(F.lit(x))) for x in ("是", "需人工判断", "TRUE", "no", "")]) == (True, True, True, False, False)
    assert one(spark, *[v.to_number(F.lit(x)) for x in ("nan", "1d", " 2.5 ", "1e-2", "")]) == (None, None, 2.5, 0.01, None)


def test_empty_words_and_blanks(spark):
    texts = ["　x\x1c ", "NaN", " null ", "\xa0", "nanny", "é "]
    df = spark.createDataFrame([(x,) for x in texts], "a string")
    filled = [row["a"] for row in v.with_filled(df, ["a"]).collect()]
    assert filled == ["x", None, None, None, "nanny", "é"]
    assert [row[0] for row in df.select(v.filled(F.col("a"))).collect()] == filled


def test_reference_splitters(spark):
    assert one(spark, v.split_refs(F.lit("A；B|C"), v.REPORT_REF_BREAK), v.split_refs(F.lit("A；B|C"), v.CLAUSE_REF_BREAK)) == (
        ["A", "B|C"], ["A", "B", "C"],
    )


@pytest.mark.parametrize(
    "left,right,score",
    [("", "a", 0.0), ("接地", "接地线", 0.95), ("abcd", "bcde", 0.375), ("ab xy", "xy ab", 0.625), ("3.6.2 ab", "AB", 0.95)],
)
def test_similarity(spark, left, right, score):
    df = t.with_tokens(spark.createDataFrame([(left, right)], "l string, r string"), {"a": F.col("l"), "b": F.col("r")})
    there, back = df.select(t.similarity(F.col("a"), F.col("b")), t.similarity(F.col("b"), F.col("a"))).first()
    assert there == back == score


def test_stages(spark):
    names = ["设备采购", "现场设备安装阶段", "other", None]
    df = spark.createDataFrame([(x,) for x in names], "s string")
    assert [r[0] for r in df.select(canonical_stage(F.col("s"))).collect()] == ["采购制造", "安装调试", "other", ""]


def test_priority(spark):
    known = ("重大", "变压器", "调试与试验", 3, 0.9, 0.7)
    df = spark.createDataFrame(
        [known, (None, None, None, None, None, None)],
        "pred_level string, device_type string, pred_category string, repeat_count int, "
        "level_confidence double, category_confidence double",
    )
    rows = decision.decide(df, "level").collect()
    assert [(r["priority_score"], r["priority_label"]) for r in rows] == [(0.97, "高"), (0.37, "低")]
    assert rows[0]["need_review"] and not rows[1]["need_review"]
    assert rows[0]["recommended_action"].endswith(rules.SUGGESTION_RULES["need_review_action"])
    assert "涉及设备为其他设备" in rows[1]["priority_reason"]


def test_category_rules(spark):
    rows = [
        ("台账与选型", "", "", ""), ("选型", "", "", ""), ("普通", "设备材质", "", ""), ("", "", "", "安装调试"),
        ("螺栓", "", "", "安装调试"), ("校验", "", "", ""), ("验收", "", "", ""), ("渗漏", "", "", ""),
    ]
    df = spark.createDataFrame(rows, "text string, problem_reason string, problem_stage string, supervision_stage string")
    # "安装调试" alone holds the word of the test rule.
    assert [r[0] for r in df.select(cleaning.category_of(df)).collect()] == [
        "资料与标识", "设计与选型", "采购与制造", "调试与试验", "安装与施工", "调试与试验", "验收与交接", "运维与环境",
    ]


def test_preparation(spark):
    base = {name: "x" for name in rules.RAW_COLUMNS}
    raws = [
        base | {"问题描述": " a\r\n b ", "问题等级": "一般", "发现时间": "2024/3/5"},
        base | {"问题描述": "a b", "问题等级": "一般", "发现时间": "未知"},
        base | {"问题描述": "未知", "问题等级": "重大"},
        base | {"问题描述": "c", "问题等级": "轻微"},
        base | {"问题描述": "d", "问题等级": "重大", "发现时间": "spring  2024"},
    ]
    names = list(rules.RAW_COLUMNS)
    df = spark.createDataFrame([(i, *[r[n] for n in names]) for i, r in enumerate(raws)], ["pos", *names])
    out = cleaning.prepare_issues(df, "pos").orderBy("sample_id").collect()
    assert [(r["sample_id"], r["text"], r["event_time"]) for r in out] == [
        ("real_v1_000001", "a b", "2024-03-05"), ("real_v1_000002", "d", "spring 2024"),
    ]
    with pytest.raises(ValueError):
        cleaning.rename_issues(df.drop("问题描述"))


def test_first_of_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("k"))
    kept = cleaning.drop_repeats(df.repartition(5), ["id"], ["k"])
    assert kept.filter("k = 'same'").first()["id"] == 0 and kept.count() == 2001


def test_numbers_over_blocks(spark):
    for step in (7, 1 << 31):  # dense and far apart
        df = spark.range(0, 700 * step, step).repartition(3)
        got = {r["id"]: r["row_no"] for r in numbering.number_rows(df, "id").collect()}
        assert got == {x: i + 1 for i, x in enumerate(range(0, 700 * step, step))}
    assert one(spark, numbering.padded_id("p_", F.lit(7)), numbering.padded_id("p_", F.lit(12345678))) == ("p_000007", "p_12345678")


def test_retraining(spark):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "sample_id string, label string")
    schema = "sample_id string, review_status string, reviewed_label string, n int"
    reviews = spark.createDataFrame([("1", "Accepted", "x", 1), ("1", "corrected", "y", 2), ("2", "pending", "z", 3)], schema)
    rows = {r["sample_id"]: r for r in feedback.retrain_dataset(base, reviews, ["n"]).collect()}
    assert (rows["1"]["label"], rows["2"]["label"]) == ("y", "b")
    assert {r["data_source"] for r in rows.values()} == {"feedback_reviewed"}
    tagged = feedback.retrain_dataset(base.withColumn("data_source", F.lit("s")), reviews, ["n"])
    assert {r["sample_id"]: r["data_source"] for r in tagged.collect()} == {"1": "s|feedback_reviewed", "2": "s"}
    none = reviews.filter("review_status = 'pending'")
    assert feedback.retrain_dataset(base, none, ["n"]).count() == 2
    assert feedback.retrain_dataset(base.drop("label"), none, ["n"]).count() == 0
    assert [r["sample_id"] for r in feedback.retrain_dataset(base.drop("label"), reviews, ["n"]).collect()] == ["1"]


def test_revision_rules(spark):
    df = spark.createDataFrame(
        [("该标准表述不明确，现场理解存在偏差。", True, "现行"), ("该标准表述不明确", False, ""), ("标准未覆盖", True, ""),
         ("普通", True, "废止"), ("未按要求", True, "现行"), ("普通", True, "现行")],
        "text string, ok boolean, status string",
    )
    out = revision.with_revision(df, F.col("ok"), F.col("status"), F.lit("依据"), F.lit(0.5))
    rows = out.withColumn("relation", revision.relation_of(F.col("ok"), F.col("revision_need_type"), F.col("status"))).collect()
    assert [(r["revision_need_type"], r["revision_need"], r["relation"]) for r in rows] == [
        ("标准表述歧义", True, "standard_ambiguous"), ("需人工判断", False, "unmatched"), ("标准缺失", True, "standard_missing"),
        ("适用性不足", True, "standard_lagging"), ("执行落实问题", False, "standard_execution"), ("需人工判断", False, "manual_review"),
    ]
    assert rows[3]["revision_priority_score"] == 0.76 and "废止" in rows[3]["revision_reason"]


def test_missing_fields_and_plain_refs(spark):
    df = spark.createDataFrame([(1, "S1；S2|S1", "标准缺失")], "n int, standard_ref string, revision_demand string")
    assert "kg_relation_confidence" in ranking.missing_fields(df.columns)
    expanded = ranking.expand(df, ["n"]).collect()
    assert [r["kg_standard_name"] for r in expanded] == ["S1", "S2", "S1"]
    assert {r["problem_id"] for r in expanded} == {"row_2"} and all(r["revision_demand"] for r in expanded)
    ranked = ranking.rank(ranking.expand(df, ["n"])).collect()
    assert [r["related_problem_count"] for r in ranked] == [2, 1] and ranked[0]["clause_missing"]


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, predicted_label string")
    row = evaluation.eval_metrics(df).first()
    assert (row["accuracy"], row["macro_f1"]) == (0.5, round((2 / 3 + 0.5 + 0) / 3, 6))
    assert tuple(evaluation.eval_metrics(df.filter("false")).first()) == (0.0, 0.0, 0.0)
    matrix = evaluation.eval_confusion(df, ["a", "b", "c"]).collect()
    assert [(r["a"], r["b"], r["c"]) for r in matrix] == [(1, 1, 0), (0, 1, 0), (0, 1, 0)]


def test_review_order_and_display(spark):
    df = spark.createDataFrame(
        [("1", "yes", 0.2, 0.9, None, "x"), ("2", "no", 0.9, 0.1, "own", "y"), ("3", "true", 0.8, 0.5, None, "z")],
        "sample_id string, need_review string, priority_score double, level_confidence double, suggested_basis string, suggestion_basis string",
    )
    assert [r["sample_id"] for r in review.review_queue(df).collect()] == ["3", "1", "2"]
    assert [r["sample_id"] for r in review.review_subset(df).collect()] == ["3", "1"]
    shown = review.display_columns(review.review_rows(df)).collect()
    assert {r["样本编号"]: r["建议依据"] for r in shown} == {"1": "x", "2": "own", "3": "z"}


def test_row_jobs_take_streams(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([("台账", "重大", "变压器")], "text string, pred_level string, device_type string").write.json(path)
    stream = spark.readStream.schema("text string, pred_level string, device_type string").json(path)
    out = decision.decide(stream.withColumn("pred_category", cleaning.category_of(stream)), "level")
    run = out.writeStream.format("memory").queryName("decided").option("checkpointLocation", str(tmp_path / "cp")).start()
    run.processAllAvailable()
    run.stop()
    row = spark.table("decided").first()
    assert (row["pred_category"], row["priority_label"]) == ("资料与标识", "中")


def test_overrides_merge():
    out = rules.merged({"a": {"x": 1, "y": 2}, "b": [1]}, {"a": {"y": 3}, "b": [2]})
    assert out == {"a": {"x": 1, "y": 3}, "b": [2]}
