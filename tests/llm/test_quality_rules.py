"""Base numbers against a plain count; the ratio separates what it was fitted on."""

import re

import pytest

from clausewise.llm import quality_rules as q
from clausewise.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = ["", " \t\n", "a", "a b c d e a b c d e", "x " * 500, "ü\n\nü\n a\n a", "#*$%&|<> ok", "a b c", "one two\r\nthree\x0bfour"]


def numbers(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    at = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(at) > 20 * len(words)
    chars = sum(map(len, words))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), len(at), failed)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def rows(df):
    return {
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in df.collect()
    }


def test_base_numbers(spark, labels):
    odd = spark.createDataFrame(
        [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "p q " * 30)], "doc_id long, text string"
    )
    docs = table(spark, SF, "documents").select("doc_id", "text").union(odd)
    got = q.filter_quality(docs.withColumn("n_words", docs.doc_id), labels)
    want = {(r.doc_id, *numbers(r.text)) for r in docs.collect()}
    assert rows(got) == want
    kept = [(r.base_failed, r.kept) for r in got.collect()]
    assert len(kept) == docs.count() and (True, True) not in kept


def test_ratio(spark):
    docs = spark.createDataFrame([(i, "good plain words here " * 5 if i % 2 else "xx!! yy!! zz!! " * 5) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.log_ratio for r in q.filter_quality(docs, labels).collect()}
    assert min(got[i] for i in range(1, 40, 2)) > 0.3 > -1 > max(got[i] for i in range(0, 40, 2))


def test_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    weights = q.bucket_weights(docs, labels)
    hit = q.mean_log_ratio(docs.withColumn("t", q.token_hashes(docs.text)), weights).withColumnRenamed("log_ratio", "r")
    for r in hit.withColumn("b", q.ngrams(q.F.col("t"))).collect():
        want = sum(weights[b] for b in r.b or []) / max(1, len(r.b or []))
        assert abs(r.r - want) < 1e-9


def test_empty(spark, labels):
    assert q.filter_quality(table(spark, SF, "documents").limit(0), labels.limit(0)).count() == 0
