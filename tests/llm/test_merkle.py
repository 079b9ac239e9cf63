"""Trees and proofs against a plain recursion."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clausewise.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, path string, block long"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(leaves, fanout):
    """Root, and the siblings of each leaf before and after it, level by level."""
    paths, own, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, at in enumerate(own):
            run = level[at // fanout * fanout :][:fanout]
            paths[k].append(("".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])))
        level = [h(level[i : i + fanout]) for i in range(0, len(level), fanout)]
        own = [at // fanout for at in own]
    return level[0], paths


def brute(rows, fanout):
    part = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    groups = {}
    for doc_id, source, lang, n, text in rows:
        groups.setdefault(source, []).append((doc_id, h(map(part, (doc_id, source, lang, n, text)))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, found = [], []
    for s in order:
        members = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        sub, paths = plain([x[1] for x in members], fanout)
        subs.append(sub)
        found.append((members, paths))
    root, tops = plain(subs, fanout)
    out = []
    for sub, (members, paths), top in zip(subs, found, tops):
        out += [(k, leaf, sub, root, tuple(p + top)) for (k, leaf), p in zip(members, paths)]
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, inner, size", [(2, 1, 37), (3, 1, 83), (3, 2, 40), (2, 2, 1), (16, 3, 300)])
def test_same_trees(spark, fanout, inner, size):
    rows = [(i * 7 % 1000, f"s{i % 5 if i % 3 else 0}", "en", i, f"text {i}") for i in range(size)]
    rows += [(None, None, None, None, None), (None, None, None, None, ""), (5, "", "x", 1, "ü" * 5000), (5, "", "x", 1, "ü" * 5000)]
    rows += [(-3, "s\U0001f600", None, 0, "a"), (2**40, "s￮", "l", 2, None)]
    docs = spark.createDataFrame([(*r, 1, "mine", 2) for r in rows], SCHEMA)
    got = merkle.manifest(docs, fanout=fanout, inner=inner).collect()
    mine = sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((x.before, x.after) for x in r.path)) for r in got), key=str)
    assert mine == brute(rows, fanout)


def test_claims(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", i, f"Text {i}", 0, "", 0) for i in range(60)], SCHEMA)
    wrong = merkle.leaf_hash([F.lower("text") if c == "text" else F.col(c) for c in merkle.FIELDS])
    right = merkle.leaf_hash([F.col(c) for c in merkle.FIELDS])
    rows = merkle.manifest(docs, claim=F.when(F.col("doc_id") == 7, wrong).otherwise(right), fanout=4, inner=1)
    checked = rows.select("doc_id", (merkle.fold(F.col("path"), F.col("claim")) == F.col("root")).alias("same")).collect()
    assert [r.doc_id for r in checked if not r.same] == [7]


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
