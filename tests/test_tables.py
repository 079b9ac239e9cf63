"""Sources, sinks, splits, labels, vectors and the classifier."""

import hashlib
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clausewise.operators import learning, splits
from clausewise.plans import queries
from clausewise.sources import tables


@pytest.mark.parametrize("suffix", [".csv", ".jsonl", ".parquet"])
def test_round_trip(spark, tmp_path, suffix):
    rows = [(1, 'say "hi", 你好\nnext', ""), (2, "  blanks  ", None), (3, "a\\b,c", "x")]
    df = spark.createDataFrame(rows, "n int, text string, other string")
    path = tables.write_table(df, str(tmp_path / "deep" / f"t{suffix}"))
    tables.write_table(df, path)
    if suffix == ".csv":  # CSV has one spelling for both kinds of empty
        rows[0] = (*rows[0][:2], None)
    assert sorted(map(tuple, tables.read_table(spark, path, df.schema).collect())) == rows
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.xlsx")


def test_split_sizes_and_reuse(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("usual").alias("label"))
    found = splits.saved_splits(spark, df, str(tmp_path / "s"), "label", "id", digits=1)
    sizes = {name: {r["label"]: r["count"] for r in part.groupBy("label").count().collect()} for name, part in found.items()}
    assert sizes == {
        "train": {"rare": 80, "usual": 720}, "valid": {"rare": 10, "usual": 90}, "test": {"rare": 10, "usual": 90},
    }
    again = splits.saved_splits(spark, df.repartition(7), str(tmp_path / "s"), "label", "id", digits=1)
    assert {r["id"] for r in again["test"].collect()} == {r["id"] for r in found["test"].collect()}
    other = splits.split_stratified(df, "label", "id", seed=1).filter("split = 'test'")
    assert {r["id"] for r in other.collect()} != {r["id"] for r in found["test"].collect()}
    with pytest.raises(ValueError):
        splits.split_stratified(df, "label", "id", train=0.9)


def test_labels(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), ("b", "y")], "label string, other string")
    mapping = learning.label_map(df)
    assert {r["label"]: r["label_id"] for r in mapping.collect()} == {"a": 0, "b": 1}
    encoded = learning.encode_labels(df, mapping).collect()
    assert sorted((r["labels"], r["label_text"], r["other"]) for r in encoded) == [(0, "a", "x"), (1, "b", ""), (1, "b", "y")]
    with pytest.raises(PySparkException):
        learning.encode_labels(df, mapping.filter("label = 'a'")).collect()


def test_feature_vectors(spark):
    issues = spark.createDataFrame([("1", "t")], "sample_id string, text string")
    vectors = spark.createDataFrame([("1", [0.5, 1.5])], "sample_id string, vector array<float>")
    row = learning.feature_matrix(learning.feature_columns(issues), vectors, dim=2).first()
    assert (row["problem_text"], row["cls_0"], row["cls_1"]) == ("t", 0.5, 1.5)
    with pytest.raises(PySparkException):
        learning.feature_matrix(issues, vectors, dim=3).collect()


def test_classifier(spark):
    rows = [(i, "接地线螺栓松动" if i % 2 else "试验报告数据缺失", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "n int, model_input string, labels int")
    model = learning.train_regression(df, features=256, max_iter=5)
    out = learning.predict_regression(df, model, ["文档", "安装"]).collect()
    assert all(r["predicted_label_id"] == r["labels"] and 0.5 < r["confidence"] <= 1 for r in out)
    assert {r["predicted_label"] for r in out} == {"文档", "安装"}


def test_naive_bayes(spark):
    rows = [(0, "aab", 0), (1, "ab", 1), (2, "", 1), (3, "zz", 2)]
    df = spark.createDataFrame(rows, "n int, model_input string, labels int")
    model = learning.train_classifier(df, 3)
    log = lambda x: round(math.log(x) * 1e6)
    got = {r["gram"]: r["weights"] for r in model.weights.collect()}
    # five different grams with the empty one: aa, ab (0); ab, '' (1); zz (2)
    counts = {"aa": (1, 0, 0), "ab": (1, 1, 0), "": (0, 1, 0), "zz": (0, 0, 1)}
    assert got == {g: [log((n + 1) / (t + 4)) for n, t in zip(c, (2, 2, 1))] for g, c in counts.items()}
    unseen = spark.createDataFrame([(7, "aa"), (8, "qq"), (9, "zz")], "n int, model_input string")
    out = {r["n"]: (r["predicted_label"], r["confidence"]) for r in learning.batch_predict(unseen, model, ["x", "y", "z"], "n").collect()}
    assert out[7][0] == "x" and out[8] == ("y", 0.5) and out[9][0] == "z"


def test_second_split_is_checked_again(spark):
    """Of ten rows each, two labels leave one row each and one of a third: valid and test are then taken from all alike."""
    rows = [(i, "a" if i < 40 else "b" if i < 45 else "c") for i in range(50)]
    df = spark.createDataFrame(rows, "n int, label string")
    got = {r["n"]: r["split"] for r in splits.split_stratified(df, "label", "n").collect()}
    sizes = {name: sum(x == name for x in got.values()) for name in ("train", "valid", "test")}
    assert sizes == {"train": 40, "valid": 5, "test": 5} and len(got) == 50
    labels = dict(rows)
    assert {x: sum(got[n] == "train" for n in got if labels[n] == x) for x in "abc"} == {"a": 32, "b": 4, "c": 4}
    mark = lambda n: hashlib.sha1(f"42:{n}".encode()).hexdigest()
    rest = sorted((n for n in got if got[n] != "train"), key=mark)
    assert [got[n] for n in rest] == ["valid"] * 5 + ["test"] * 5  # in the order of all, not label by label


def test_given_splits(spark, tmp_path):
    frame = lambda ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "id int, text string")
    given = {"train": frame([1, 2, 2]), "valid": frame([3, None]), "test": frame([4, None]).select("text", "id")}
    got = splits.given_splits(given, str(tmp_path / "s"), "id")
    assert {n: sorted(str(r["id"]) for r in df.collect()) for n, df in got.items()} == {
        "train": ["1", "2", "2"], "valid": ["3", "None"], "test": ["4", "None"],
    }
    with pytest.raises(ValueError, match="two splits"):
        splits.given_splits({**given, "test": frame([2])}, str(tmp_path / "t"), "id")
    with pytest.raises(ValueError, match="columns"):
        splits.given_splits({**given, "test": frame([9]).withColumn("x", F.lit(1))}, str(tmp_path / "t"), "id")


def test_pieces_of_a_large_table_do_not_grow(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one, cores = spark.read.parquet(str(tmp_path / "one")), spark.sparkContext.defaultParallelism
    assert tables.spread(one).rdd.getNumPartitions() == cores
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 30)
    dealt = tables.spread(one)
    assert dealt.rdd.getNumPartitions() == max(cores, 34) and dealt.count() == 1000
    empty = spark.read.schema("id long").parquet(str(tmp_path / "one")).where("id < 0")
    assert tables.spread(empty).count() == 0


def test_written_csv_is_packed(spark, tmp_path, monkeypatch):
    """The query's CSV is packed, in files that one task each can read, and comes back as it was."""
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 300)
    rows = [(i, f'say "{i % 7}",\nnext \\n', None if i % 5 else "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "n int, text string, other string").coalesce(1)
    back = queries._round_trip(df, ".csv")
    files = back.inputFiles()
    assert len(files) == 4 and all(f.endswith(".csv.lz4") for f in files)
    assert sorted(map(tuple, back.collect())) == rows
    plain = tables.write_table(df, str(tmp_path / "t.csv"))
    assert all(f.endswith(".csv") for f in tables.read_table(spark, plain, df.schema).inputFiles())
