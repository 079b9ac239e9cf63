"""Links and components against all pairs."""

import re

import numpy as np
import pytest

from clausewise.llm import near_dedup, shingles
from clausewise.llm.common import components, table

SF = "/root/testdata/sf0.001"


def plain_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (set size, component, kept) for distinct, non-null doc_ids."""
    sets = {d: plain_set(t) for d, t in rows}
    ids = sorted(sets)
    low = {d: d for d in ids}

    def root(d):
        while low[d] != d:
            d = low[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def family(rng, n, base=0):
    """Chains of edits around one text, some near, some far."""
    vocabulary = [f"w{i}" for i in range(5000)]
    start = rng.choice(vocabulary, 120)
    out, texts = [], [start]
    for i in range(n):
        words = texts[rng.integers(len(texts))].copy()
        for at in rng.integers(0, 120, rng.integers(1, 7)):
            words[at] = rng.choice(vocabulary)
        texts.append(words)
        out.append((base + i, " ".join(words)))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, component long, id long")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.link(docs).collect()}
    assert got == brute(rows)


def test_families(spark):
    rng = np.random.default_rng(5)
    rows = family(rng, 150) + family(rng, 40, 1000) + [(2000, ""), (2001, None), (2002, " \n"), (2003, "Ab c"), (2004, "aB\tc")]
    check(spark, rows + [(2005, "É b"), (2006, "é b"), (3000, "x " * 4000), (2999, "X " * 5000)])


def test_documents(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(spark, rows)


def test_null_repeated_and_empty(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (5, "a b c"), (4, "A b c"), (4, "z y x w v u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.link(docs).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(5, 4, False)] * 2 + [(4, 4, True)] * 2, key=str)
    assert near_dedup.link(docs.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 2**63, 700, dtype=np.uint64)
    a, b = items[:600], items[100:]
    same = (near_dedup.sketch(a, 512) == near_dedup.sketch(b, 512)).mean()
    assert abs(same - 500 / 700) < 0.08
    few = items[:3]  # the last rounds fill what the first leave empty
    assert (near_dedup.sketch(few, 64) != np.iinfo(np.uint64).max).all()
    assert (near_dedup.sketch(few, 64) == near_dedup.sketch(few[::-1].copy(), 64)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_shingle_sets_have_the_right_size(seed):
    rng = np.random.default_rng(seed)
    for n in (0, 1, 4, 5, 6, 300):
        text = " \n".join(rng.choice(["a", "bb", "C", "é"], n))
        assert len(shingles.shingle_set(text)) == len(plain_set(text))


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    vertices = spark.range(45).union(spark.range(100, 103)).toDF("id")
    got = {r.id: r.component for r in components(vertices, edges).collect()}
    assert got == {**{i: 0 if i <= 40 else i for i in range(45)}, 100: 100, 101: 100, 102: 102}
