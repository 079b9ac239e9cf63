"""Merkle manifest of a data set, upper proofs by butterfly exchange (operator 12).

Every row is a leaf. The leaves of a group (a source) form a tree of the given fanout; the roots of the
groups, ordered by group, form a tree with the root of the whole. The proof of a row is its ``path``:
for each level up to the root what stands before and after its own node in the hashed run.

Leaves are numbered per group and cut into aligned blocks of FANOUT ** INNER leaves, one row each; a block's own
subtree is hashed in its task. Upper levels go by butterfly rounds: in round r the blocks whose numbers
differ only in digit r (base FANOUT) swap the root of the subtree that each has so far, all of them
hash the common ancestor, and each appends the roots of the others to its path. A block therefore
holds its whole upper proof after the last round, and nothing is sent down. Where the last subtree
of a run is incomplete, its blocks stand in for the missing ones. A group of the exchange has at most FANOUT
members. Only the largest number of blocks reaches the driver.

Order within a group: by the order column (null first), then by leaf. Repeated rows are leaves of their own
with paths of their own. A null group is a group, the first one. Null fields hash as ``-``, an empty text as
``0:``; texts of any length are hashed whole. An empty table has no rows and no root. Columns beside
the fields are neither hashed nor returned, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.llm.common import small_batches, table
from clausewise.operators.numbering import number_rows
from clausewise.session import materialise

FANOUT = 16
#: Levels of the tree that are hashed within one task; a block has FANOUT ** INNER leaves.
INNER = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX = 64


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field with its length in bytes, a null one as a dash."""
    texts = [c.cast("string") for c in fields]
    parts = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in texts]
    return F.sha2(F.concat(*parts), 256)


def _parent(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(leaves: list[str], in_group: int, fanout: int, inner: int) -> list[list[str]]:
    """The leaves of a block and the nodes above them, up to the block's root."""
    levels, width = [leaves], 1
    while width < min(in_group, fanout**inner):
        below = levels[-1]
        levels.append([_parent(below[i : i + fanout]) for i in range(0, len(below), fanout)])
        width *= fanout
    return levels


def _hex(packed: bytes) -> list[str]:
    text = packed.hex()
    return [text[i : i + HEX] for i in range(0, len(text), HEX)]


def _blocks(rows: DataFrame, order: str, fanout: int, inner: int) -> DataFrame:
    """(tree, block, in_group, node, keys, leaves, claims): one row per block of leaves, written once."""
    kind = dict(rows.dtypes)[order]
    thin = materialise(rows)
    spread = thin.repartitionByRange("tree", order, "leaf").withColumn("part", F.spark_partition_id())
    placed = materialise(spread)
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("tree")).alias("in_group"),
    )
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(order, "leaf")) - 1
    numbered = placed.withColumn("inside", inside).join(starts, ["tree", "part"]).withColumn("pos", F.col("start") + F.col("inside"))
    thin = numbered.select("tree", F.floor(F.col("pos") / fanout**inner).alias("block"), "pos", "in_group", order, "leaf", "claim")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos").combine_chunks()
        in_group = group["in_group"][0].as_py()
        leaves = group["leaf"].to_pylist()
        row = {
            "tree": group["tree"][:1], "block": group["block"][:1], "in_group": group["in_group"][:1],
            "node": pa.array([_levels([x.hex() for x in leaves], in_group, fanout, inner)[-1][0]]),
            "keys": pa.ListArray.from_arrays(np.array([0, group.num_rows], np.int32), group[order].combine_chunks()),
            "leaves": pa.array([b"".join(leaves)]), "claims": pa.array([b"".join(group["claim"].to_pylist())]),
        }
        return pa.table(row)

    schema = f"tree string, block long, in_group long, node string, keys array<{kind}>, leaves binary, claims binary"
    return materialise(thin.groupBy("tree", "block").applyInArrow(run, schema))


def butterfly(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(tree, block, node, path): the root of each tree and each block's way to it.

    nodes has tree, block (0, 1, ... without gaps), blocks (their number in the tree) and node (the block's root).
    """
    most = nodes.agg(F.max("blocks")).first()[0] or 0
    state = nodes.select("tree", "block", "blocks", "node", F.array().cast(PATH).alias("path"))
    step = 1
    while step < most:
        state = _round(state, step, fanout)
        step *= fanout
    return state.select("tree", "block", "node", "path")


def _round(state: DataFrame, step: int, fanout: int) -> DataFrame:
    """Blocks that differ in one digit only swap subtree roots and hash the ancestor."""
    block, digit = F.col("block"), (F.floor(F.col("block") / step) % fanout).alias("digit")
    key = [F.floor(block / (step * fanout)).alias("high"), (block % step).alias("low")]
    active = state.where(F.col("blocks") > step)
    own = active.select("tree", "blocks", *key, digit, "node", "block", "path")
    last = F.floor((F.col("blocks") - 1) / step)
    size = F.col("blocks") - last * step
    stands_in = (F.floor(block / step) == last) & (last % fanout > 0) & (block % step + size < step)
    missing = F.explode(F.sequence(block % step + size, F.lit(step - 1).cast("long"), size)).alias("low")
    copies = active.where(stands_in).select(
        "tree", "blocks", key[0], missing, digit, "node",
        F.lit(None).cast("long").alias("block"), F.lit(None).cast(PATH).alias("path"),
    )
    member = F.struct("digit", "node", "block", "path")
    met = own.unionByName(copies).groupBy("tree", "blocks", "high", "low").agg(F.array_sort(F.collect_list(member)).alias("run"))
    text = lambda run: F.array_join(F.transform(run, lambda x: x["node"]), "")
    whole = met.select("tree", "blocks", "run", F.sha2(text(F.col("run")), 256).alias("node"), F.explode("run").alias("own"))
    before = F.filter("run", lambda x: x["digit"] < F.col("own.digit"))
    after = F.filter("run", lambda x: x["digit"] > F.col("own.digit"))
    sides = F.struct(text(before).alias("before"), text(after).alias("after"))
    moved = whole.where("own.block is not null").select(
        "tree", F.col("own.block").alias("block"), "blocks", "node", F.concat("own.path", F.array(sides)).alias("path")
    )
    return state.where(F.col("blocks") <= step).unionByName(moved)


def manifest(
    docs: DataFrame,
    group: str = "source",
    order: str = "doc_id",
    fields: Sequence[str] = FIELDS,
    claim: Column | None = None,
    *,
    fanout: int = FANOUT,
    inner: int = INNER,
) -> DataFrame:
    """(order column, leaf, claim, subroot, root, path) for every row.

    ``claim`` is the leaf as someone else states it (by default the row's own); fold it along the path to check it.
    ``path`` lists, from the leaf's own run to the run of the groups' roots, the digests before and after the own one.
    """
    leaf = leaf_hash([F.col(f"`{c}`") for c in fields])
    key = F.when(F.col(f"`{group}`").isNull(), "").otherwise(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")))
    rows = docs.select(
        key.alias("tree"), F.col(f"`{order}`").alias("_key"), F.unhex(leaf).alias("leaf"), F.unhex(leaf if claim is None else claim).alias("claim")
    )
    blocks = _blocks(rows, "_key", fanout, inner)
    count = F.ceil(F.col("in_group") / fanout**inner)
    upper = materialise(butterfly(blocks.select("tree", "block", count.alias("blocks"), "node"), fanout))
    groups = upper.where("block = 0").select("tree", "node")
    ranks = number_rows(groups.select("tree"), "tree", "rank")
    ranked = groups.join(ranks, "tree").select(F.lit("").alias("tree"), (F.col("rank") - 1).alias("block"), "node", F.col("tree").alias("name"))
    ranked = materialise(ranked.withColumn("blocks", F.lit(groups.count()).cast("long")))
    tops = butterfly(ranked, fanout).join(ranked.select("block", "name"), "block")
    tops = tops.select(F.col("name").alias("tree"), F.col("node").alias("root"), F.col("path").alias("top"))
    ways = upper.join(tops, "tree").select("tree", "block", F.col("node").alias("subroot"), "root", F.concat("path", "top").alias("upper"))
    kind = dict(docs.dtypes)[order]
    joined = blocks.drop("node").join(ways, ["tree", "block"]).drop("tree", "block")
    out = f"_key {kind}, leaf string, claim string, subroot string, root string, path {PATH}"
    return joined.mapInArrow(partial(_paths, fanout=fanout, inner=inner), out).withColumnRenamed("_key", order)


def _paths(batches: Iterator[pa.RecordBatch], fanout: int, inner: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 1):
        row = batch.select(["in_group", "leaves", "claims", "subroot", "root", "upper"]).to_pylist()[0]
        leaves = _hex(row["leaves"])
        before, after = [], []
        levels = _levels(leaves, row["in_group"], fanout, inner)[:-1]
        runs = [["".join(level[i : i + fanout]) for i in range(0, len(level), fanout)] for level in levels]
        for at in range(len(leaves)):
            for level in runs:
                at, place = divmod(at, fanout)
                before.append(level[at][: HEX * place])
                after.append(level[at][HEX * (place + 1) :])
            before.extend([x["before"] for x in row["upper"]])
            after.extend([x["after"] for x in row["upper"]])
        n, depth = len(leaves), len(runs) + len(row["upper"])
        ends = np.arange(n + 1, dtype=np.int32) * np.int32(depth)
        sides = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("keys").flatten(), pa.array(leaves), pa.array(_hex(row["claims"])),
                pa.array([row["subroot"]] * n), pa.array([row["root"]] * n),
                pa.ListArray.from_arrays(ends, sides),
            ],
            ["_key", "leaf", "claim", "subroot", "root", "path"],
        )


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x["before"], node, x["after"]), 256))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; a fifth of them are checked with a text in lower case."""
    docs = table(spark, sf_dir, "documents")
    changed = F.translate("text", UPPER, LOWER)
    forged = leaf_hash([changed if c == "text" else F.col(c) for c in FIELDS])
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    claim = F.when(tampered, forged).otherwise(leaf_hash([F.col(c) for c in FIELDS]))
    sides = F.transform("path", lambda x: F.concat(x["before"], x["after"]))
    rows = manifest(docs, claim=claim).withColumn("folded_root", fold(F.col("path"), F.col("claim")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(sides, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k::INT) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""


def _oracle(levels: int) -> str:
    """The same in SQL, for groups of at most FANOUT ** levels documents and as many groups."""
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    row = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    steps = []

    def climb(name: str, start: str) -> None:
        """Levels of the trees of (tree, pos, n, node); a tree of one node is its own root."""
        steps.append(f"{name}0 AS ({start})")
        for i in range(levels):
            steps.append(
                f"{name}{i + 1} AS (SELECT tree, pos // {FANOUT} AS pos, (min(n) + {FANOUT - 1}) // {FANOUT} AS n, CASE WHEN min(n) = 1 "
                f"THEN min(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node FROM {name}{i} GROUP BY tree, pos // {FANOUT})"
            )

    def side(name: str, level: int, at: str, which: str) -> str:
        same = f"{name}{level}.tree = {at}.tree AND pos // {FANOUT} = {at}.pos // {FANOUT ** (level + 1)}"
        other = f"pos {which} {at}.pos // {FANOUT**level}"
        return f"coalesce((SELECT string_agg(node, '' ORDER BY pos) FROM {name}{level} WHERE {same} AND n > 1 AND {other}), '')"

    climb(
        "l",
        "SELECT coalesce('+' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, "
        f"count(*) OVER (PARTITION BY source) AS n, {row('text')} AS node, doc_id, "
        f"CASE WHEN {CRC32.format('doc_id::VARCHAR')} % 5 = 0 THEN {row(lower)} ELSE {row('text')} END AS claim FROM documents",
    )
    climb(
        "g",
        f"SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node, tree AS name FROM l{levels}",
    )
    ways = [("l", i, "d") for i in range(levels)] + [("g", i, "s") for i in range(levels)]
    pairs = ", ".join(
        f"{side(name, i, at, '<')} AS b{k}, {side(name, i, at, '>')} AS a{k}, "
        f"(SELECT any_value(n) > 1 FROM {name}{i} WHERE {name}{i}.tree = {at}.tree) AS m{k}"
        for k, (name, i, at) in enumerate(ways)
    )
    folded = "claim"
    for k in range(len(ways)):
        steps.append(
            f"f{k} AS (SELECT *, CASE WHEN m{k} THEN sha256(b{k} || {folded} || a{k}) ELSE {folded} END AS w{k} FROM {f'f{k - 1}' if k else 'p'})"
        )
        folded = f"w{k}"
        if k == 0:
            steps.insert(-1, f"p AS (SELECT d.doc_id, d.node AS leaf, d.claim, s.node AS subroot, {pairs} FROM l0 d JOIN g0 s ON s.name = d.tree)")
    proof = " || ".join(f"b{k} || a{k}" for k in range(len(ways)))
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, leaf, subroot, r.node AS root, sha256({proof}) AS proof_sha256, "
        f"{folded} AS folded_root, {folded} = r.node AS verified FROM f{len(ways) - 1}, g{levels} r"
    )


ORACLE = _oracle(4)
