"""Held-out accuracy, and what odd rows and labels give."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clausewise.llm import quality_ranking, toxicity
from clausewise.llm.common import table

SF = "/root/testdata/sf0.1"


def auc(rows):
    ordered = sorted(rows)
    good = sum(y for _, y in rows)
    rank = sum(i + 1 for i, (_, y) in enumerate(ordered) if y)
    return (rank - good * (good + 1) / 2) / (good * (len(rows) - good))


@pytest.mark.parametrize(
    "query,label,least", [(toxicity.op1_toxicity, "toxic", 0.97), (quality_ranking.op4_quality_ranking, "quality", 0.97)]
)
def test_held_out(spark, query, label, least):
    out = query(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = table(spark, SF, "labels").select("doc_id", F.col(label).alias("y"))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == table(spark, SF, "documents").count()
    wrong = [sum(r.predicted != y for r in rows if r.y == y) / sum(r.y == y for r in rows) for y in (0, 1)]
    print(label, len(rows), auc([(r.score, r.y) for r in rows]), wrong)
    assert auc([(r.score, r.y) for r in rows]) >= least
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_ranking, "quality")])
def test_odd_rows(spark, module, label):
    texts = [None, "", "x", "y " * 40000, "w" * 50000, "same", "same"]
    docs = spark.createDataFrame([(i if t else None, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, p string")
    for rows, want in (([], None), ([(3, 1)], None), ([(i, i % 2) for i in range(7)] + [(3, None), (None, 1)], None)):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        scored = module.Model(docs, labels).score(docs, ["doc_id", "p"])
        got = scored.collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got) and scored.columns == ["doc_id", "p", "score"]
        assert module.Model(docs.limit(0), labels).score(docs.limit(0), ["doc_id"]).count() == 0


def test_lexicon_and_features(spark):
    rows = [("you are a zorgling fool", 1)] * 6 + [("zorgful talk of the fool", 1)] * 6 + [("talk of the town", 0)] * 30
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert {"zorg-", "fool"} <= set(lexicon) and not {"talk", "the"} & set(lexicon)
    odds = toxicity.Odds(lexicon)
    named = dict(zip(toxicity.FEATURES, toxicity.features("YOU zorgest!! f00l", odds)))
    assert named["weak_share"] > 0 and named["person_share"] > 0 and named["obfuscated"] == 0 and named["shouted_share"] > 0
    assert odds["town"] == 0.0 and len(toxicity.features("", odds)) == len(toxicity.FEATURES)
    assert len(quality_ranking.features("")) == len(quality_ranking.FEATURES)


def test_quality_is_fitted_on_all_labelled_rows(spark):
    """Bad rows are known only beyond the 15,000 least hashes of ids."""
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    place = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    labels = ids.select("doc_id", (place <= 15_000).cast("int").alias("quality"))
    docs = labels.select("doc_id", F.when(F.col("quality") == 1, "some calm words, and more.").otherwise("BUY!!! $$ ##").alias("text"))
    model = quality_ranking.Model(docs, labels)
    least, most = model.score(docs, ["doc_id"]).join(labels, "doc_id").agg(
        F.min(F.when(F.col("quality") == 1, F.col("score"))), F.max(F.when(F.col("quality") == 0, F.col("score")))
    ).first()
    assert most < quality_ranking.THRESHOLD < least


def test_every_labelled_row_is_in_a_pair(spark):
    rows = [(i, int(i % 7 > 0), [i]) for i in range(3_000)] + [(3, 1, [-3])]
    cells = spark.createDataFrame(rows, "doc_id long, label int, cells array<int>")
    pairs = quality_ranking.preference_pairs(cells, {0: 429, 1: 2_571}).collect()
    assert {r.good[0] for r in pairs} | {r.bad[0] for r in pairs} == {c[0] for _, _, c in rows}
    assert len(pairs) <= quality_ranking.PAIRS_EACH * len(rows)
    assert all(r.good[0] % 7 and r.bad[0] % 7 == 0 for r in pairs)
