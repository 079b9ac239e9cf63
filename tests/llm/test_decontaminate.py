"""Passages against a full alignment of every item with every text."""

import numpy as np
import pytest

from clausewise.llm import decontaminate as d
from clausewise.llm.common import table

SF = "/root/testdata/sf0.001"


def edits(pattern, data):
    """Fewest edits of a pattern anywhere in a text."""
    row = np.zeros(len(data) + 1, np.int64)
    text, steps = np.frombuffer(data, np.uint8), np.arange(len(data) + 1)
    for i, letter in enumerate(pattern):
        step = np.concatenate([[i + 1], np.minimum(row[:-1] + (text != letter), row[1:] + 1)])
        row = np.minimum.accumulate(step - steps) + steps
    return int(row.min())


def brute(items, text):
    data, out = d.normal(text), []
    for i, pattern in items:
        best = edits(pattern, data)
        if best <= len(pattern) * d.EDIT_PERCENT // 100:
            out.append((i, best))
    return out


def changed(rng, text, n):
    letters = list(text)
    for _ in range(n):
        at = rng.integers(len(letters))
        kind = rng.integers(3)
        if kind == 0:
            letters[at] = "#"
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, "~")
    return "".join(letters)


def test_edited_passages(spark):
    rng = np.random.default_rng(7)
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()][:12]
    rows = [(i, d.normal(t)) for i, t in items] + [(900, b"tiny one"), (901, b"somewhat longer")]
    ready = d.Items(rows)
    other = "".join(t[::-1] for _, t in items)[:600]
    n = 0
    for i, text in items:
        k = len(d.normal(text)) * d.EDIT_PERCENT // 100
        for many in (0, 1, k // 2, k, k + 1, 2 * k + 3):
            part = changed(rng, text, many)
            for whole in (part, other + part + other, part + " " + other, other + "\n\t" + part.upper(), other + part[: len(part) // 2]):
                want = brute(rows, whole)
                assert d.passages(ready, whole) == want
                n += bool(want)
    assert n > 100
    assert d.passages(ready, "a TINY\n one") == [(900, 0)]


def test_documents(spark):
    docs, bench = table(spark, SF, "documents").limit(60), table(spark, SF, "benchmark")
    rows = d.read_items(bench)
    got = d.find(docs.select("doc_id", "text").withColumn("passages", docs.doc_id), bench).collect()
    assert len(got) == 60
    for r in got:
        assert [(x.item_id, x.edits) for x in r.passages] == brute(rows, r.text)


def test_repeats_inside_a_text():
    rows = [(1, b"abababababababababababababababababababab"), (2, b"the same words the same words the same words again")]
    ready = d.Items(rows)
    for text in ("ab" * 3000, "ab" * 19, "ab" * 18 + "b", "the same words " * 500, "the same words the same words the sane words again"):
        assert d.passages(ready, text) == brute(rows, text)


def test_empty_and_null(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "some text with words"), (None, "some text with words")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "TEXT  with words"), (4, "text with words"), (None, "some"), (6, None), (7, " ")], "item_id long, text string")
    got = sorted([(x.item_id, x.edits) for x in r.passages] for r in d.find(docs, bench).collect())
    assert got == [[], [], [(4, 0)], [(4, 0)]]
    assert all(r.passages == [] for r in d.find(docs, bench.limit(0)).collect())
    assert d.find(docs.limit(0), bench).count() == 0


def test_benchmark_bound(spark, monkeypatch):
    monkeypatch.setattr(d, "MAX_BENCHMARK_BYTES", 3)
    with pytest.raises(ValueError):
        d.read_items(spark.createDataFrame([(1, "abcd")], "item_id long, text string"))


def brute_parts(items, text):
    """(item id, windows) by a full alignment of every window of the items that do not stand whole."""
    data, out, whole = d.normal(text), [], {i for i, _ in brute(items, text)}
    for i, pattern in items:
        n = sum(edits(pattern[at : at + d.WINDOW_BYTES], data) <= d.WINDOW_EDITS for at in d.windows(len(pattern)))
        if n and i not in whole:
            out.append((i, n))
    return out


def test_middle_line_gone(spark):
    """What line dedup leaves of a passage: its first and its last lines."""
    rng = np.random.default_rng(5)
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    rows = [(i, d.normal(t)) for i, t in items if len(d.normal(t)) >= 240][:8]
    assert len(rows) == 8
    ready = d.Items(rows)
    for i, data in rows:
        text, third = data.decode(errors="ignore"), len(data) // 3
        rest = data[:third].decode(errors="ignore") + "\n" + data[2 * third :].decode(errors="ignore")
        for left in (rest, "before " + changed(rng, rest, 2) + " after", "x" * 90 + data[-79:].decode(errors="ignore"), text[:50], text):
            assert d.whole_and_parts(ready, left) == (brute(rows, left), brute_parts(rows, left))
        assert not d.passages(ready, rest) and [x for x, _ in d.whole_and_parts(ready, rest)[1]] == [i]
    docs = spark.createDataFrame([(i, rest) for i, rest in enumerate([rest, "clean", None])], "doc_id long, text string")
    got = d.find(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).orderBy("doc_id").collect()
    assert [([tuple(p)[0] for p in r.parts], r.passages) for r in got] == [([7], []), ([], []), ([], [])]
