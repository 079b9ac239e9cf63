"""Trie of conversation prefixes by van Emde Boas recursion (operator 11).

A node is a distinct sequence of the first turns of conversations; its members are the conversations that start
with it. Sequences are cut at half depth: the first halves make the upper trie, the second halves a
forest under each cut prefix. A cut prefix gets a name (a 128-bit digest of the name it stands under and of the
first half's digest), and both halves are cut again at the same time, until single turns are left: a node is then
a turn under a name. The halves above CHUNK turns are rows of tables, cut by ``_recurse`` in as many rounds as the
longest conversation has doublings; the last CHUNK turns are halved inside a row.

Totals of subtrees go the other way. Every node counts for its smallest member, so what lies below a node is a sum
over its members of what each still has to come. Within a row that is a sum of the rest; what the lower
halves hold is grafted on to the upper ones by the same recursion; one sum per node then ends it.

No step gathers a conversation, or the members of a node, in one row or task: turns are numbered in ranges,
sums are partial before they are shuffled, parents with many children are looked up by broadcast (there
are fewer than HOT_KEYS of them, see ``common.lookup``). One thing has to be read in order, the SHA-256 of a node's
list of ends: ranges write pieces of it in parallel and a task runs over the pieces without holding them.

Null role and text are empty. Turns are ordered by turn (null first), ties by the digest of role and text; repeated
rows are turns of their own. Rows without conv_id belong to no conversation and are left out. A conversation
that is given without turns is a member of the root alone; without conversations there is no node, not even the root.
Other columns are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.llm.common import lookup, small_batches, table
from clausewise.llm.merkle import CRC32
from clausewise.session import materialise

#: Doublings that are cut within one row.
BITS = 4
ROOT = "00" * 16
WORD = r"[^\x20\x09-\x0D]+"
#: Members whose ids go into one piece of a node's list.
PIECE = 4096
EMPTY = hashlib.sha256(b"").hexdigest()
REBUILT_FROM, HEADS = 20, 4


def _digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _root() -> Column:
    return F.unhex(F.lit(ROOT))


def number_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, in_conv, turn_name, words): turns with their place from 0, written once."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    thin = turns.where("conv_id is not null").select(
        "conv_id", "turn", name.alias("turn_name"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    order = ["conv_id", "turn", "turn_name"]
    spread = materialise(thin).repartitionByRange(*order).withColumn("block", F.spark_partition_id())
    placed = materialise(spread)
    counts = placed.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("in_conv"),
    )
    inside = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "turn_name")) - 1
    numbered = placed.withColumn("inside", inside).join(starts, ["conv_id", "block"])
    return materialise(numbered.select("conv_id", (F.col("start") + F.col("inside")).alias("pos"), "in_conv", "turn_name", "words"))


def _recurse(
    blocks: DataFrame,
    most: int,
    combine: Callable[[Column, Column], Column],
    upper: Callable[[Column, Column, Column], Column],
    lower: Callable[[Column, Column, Column], Column],
    first: Column,
) -> DataFrame:
    """(conv_id, b, carry): what reaches block b of a sequence when it is cut in halves down to single blocks.

    blocks has conv_id, b and value; the value of a longer block is ``combine`` of its halves. A block with the carry c
    hands ``upper(c, left, right)`` to its upper and ``lower(c, left, right)`` to its lower half.
    """
    levels, odd = [blocks], F.col("b") % 2 == 1
    while most > 1:
        pairs = levels[-1].groupBy("conv_id", F.floor(F.col("b") / 2).alias("half")).agg(
            F.max(F.when(~odd, F.col("value"))).alias("left"), F.max(F.when(odd, F.col("value"))).alias("right"),
            F.max("b").alias("last"),
        )
        whole = pairs.select("conv_id", F.col("half").alias("b"), "left", "right", (F.col("last") % 2 == 1).alias("both"))
        levels.append(materialise(whole.withColumn("value", combine(F.col("left"), F.col("right")))))
        most = (most + 1) // 2
    carry = levels[-1].select("conv_id", "b", first.alias("carry"))
    given = (F.col("carry"), F.col("left"), F.col("right"))
    for level in reversed(levels[1:]):
        half = lambda b, c: F.struct(b.alias("b"), c.alias("carry"))
        two = F.array(half(F.col("b") * 2, upper(*given)), F.when(F.col("both"), half(F.col("b") * 2 + 1, lower(*given))))
        cut = level.join(carry, ["conv_id", "b"]).select("conv_id", F.explode(F.filter(two, lambda x: x.isNotNull())).alias("x"))
        carry = cut.select("conv_id", "x.b", "x.carry")
    return carry


def _halves(names: Column) -> Column:
    """Digests of the whole pairs of a list."""
    pair = lambda i: _digest(F.get(names, 2 * i), F.get(names, 2 * i + 1))
    places = F.sequence(F.lit(0), F.floor(F.size(names) / 2).cast("int") - 1)
    return F.when(F.size(names) > 1, F.transform(places, pair)).otherwise(F.array().cast("array<binary>"))


def _named(chunks: DataFrame, most: int, bits: int) -> DataFrame:
    """Chunks with ``nodes``, the names of their prefixes, and ``before``, the name of the prefix above them."""
    sized = chunks.withColumn("d0", F.col("turn_names"))
    for level in range(1, bits + 1):
        sized = sized.withColumn(f"d{level}", _halves(F.col(f"d{level - 1}")))
    whole = F.get(f"d{bits}", F.lit(0))
    long = F.col("length") > 1 << bits
    blocks = sized.where(long).select("conv_id", F.col("chunk").alias("b"), whole.alias("value"))
    under = lambda c, left, right: _digest(c, left)
    cuts = _recurse(materialise(blocks), most, _digest, lambda c, left, right: c, under, _root())
    cuts = cuts.where("b > 0").select("conv_id", F.col("b").alias("chunk"), F.col("carry").alias("cut"))
    later = sized.where(long & (F.col("chunk") > 0)).join(cuts, ["conv_id", "chunk"])
    rows = sized.where("chunk = 0").withColumn("cut", _root()).unionByName(later)
    rows = rows.withColumn("f", F.array("cut"))
    for level in reversed(range(bits)):
        above, left = F.col("f"), F.col(f"d{level}")
        places = F.sequence(F.lit(0), F.shiftright(F.size("turn_names") - 1, level))
        name = lambda q: F.get(above, F.shiftright(q, 1))  # noqa: B023, E731
        cut = F.transform(places, lambda q: F.when(q % 2 == 0, name(q)).otherwise(_digest(name(q), F.get(left, q - 1))))  # noqa: B023
        rows = rows.withColumn("g", cut).drop("f").withColumnRenamed("g", "f")
    nodes = F.zip_with("f", "turn_names", lambda f, turn: _digest(f, turn))
    named = materialise(rows.select("conv_id", "chunk", "length", nodes.alias("nodes"), "words"))
    last = named.where(F.col("length") > (F.col("chunk") + 1) * (1 << bits))
    last = last.select("conv_id", (F.col("chunk") + 1).alias("chunk"), F.element_at("nodes", -1).alias("before"))
    top = named.where("chunk = 0").withColumn("before", _root())
    return top.unionByName(named.where("chunk > 0").join(last, ["conv_id", "chunk"]))


def prefix_trie(turns: DataFrame, convs: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Nodes and the ends of conversations.

    turns has conv_id, pos (0, 1, ... without gaps), turn_name (16 bytes) and words; convs has conv_id once and length,
    its number of turns. The first frame has node and parent (names; the root's is ROOT, its parent null),
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens. The second one
    has node and conv_id for every conversation, the node being the one at which it ends.
    """
    size = 1 << bits
    item = F.struct("pos", "turn_name", "words")
    chunks = turns.groupBy("conv_id", F.floor(F.col("pos") / size).alias("chunk")).agg(F.array_sort(F.collect_list(item)).alias("t"))
    lengths = convs.select("conv_id", "length", F.ceil(F.col("length") / size).alias("_uses"))
    chunks = chunks.select("conv_id", "chunk", F.col("t.turn_name").alias("turn_names"), F.col("t.words").alias("words"))
    chunks = materialise(chunks)
    known = materialise(lookup(chunks, lengths, "conv_id", chunks.count()))
    longest = convs.agg(F.max("length")).first()[0] or 0
    most = max(1, -(-longest // size))
    named = materialise(_named(known, most, bits))

    parents = F.concat(F.array("before"), F.slice("nodes", 1, F.size("nodes") - 1))
    zipped = F.posexplode(F.arrays_zip(F.col("nodes").alias("node"), parents.alias("parent"), F.col("words").alias("words")))
    depth = F.col("chunk") * size + F.col("p") + 1
    rows = named.select("conv_id", "chunk", "length", zipped.alias("p", "x")).select("conv_id", depth.alias("depth"), "length", "x.*")
    counted = rows.groupBy("node", "parent", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    counted = materialise(counted)
    children = counted.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = counted.join(children, "node", "left").na.fill(0, ["n_children"])
    leaf = (F.col("n_children") == 0).cast("long")
    nodes = materialise(nodes.withColumns({"leaf": leaf, "saved": (F.col("n_convs") - 1) * F.col("words")}))

    below = _below(named, nodes, most, size)
    whole = nodes.join(below, "node")
    root = _root_row(convs, nodes)
    root_conv = root.select("conv_id").scalar()
    owner = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    deep = whole.where("depth > 1")
    placed = lookup(deep, owner.withColumnRenamed("n_children", "_uses"), "parent", nodes.count())
    placed = placed.unionByName(whole.where("depth = 1").withColumn("parent_conv_id", root_conv))
    kept = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = rows.where("depth = length").select("node", "conv_id")
    turnless = convs.where("length = 0").select(_root().alias("node"), "conv_id")
    return placed.select(*kept).unionByName(root.select(*kept)), ends.unionByName(turnless)


def _below(named: DataFrame, nodes: DataFrame, most: int, size: int) -> DataFrame:
    """(node, n_leaves, saved_tokens): sums over the subtree of each node, itself included."""
    own = F.struct(((F.col("depth") - 1) % size).alias("p"), "leaf", "saved")
    owned = nodes.groupBy("conv_id", F.floor((F.col("depth") - 1) / size).alias("chunk")).agg(F.collect_list(own).alias("own"))
    rest = lambda field, p: F.aggregate(
        F.filter("own", lambda x: x["p"] >= p), F.lit(0).cast("long"), lambda total, x: total + x[field]
    )
    both = lambda a, b: F.struct((a["leaf"] + b["leaf"]).alias("leaf"), (a["saved"] + b["saved"]).alias("saved"))
    none = F.struct(F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    held = named.select("conv_id", "chunk", "length", "nodes").join(owned, ["conv_id", "chunk"], "left")
    held = materialise(held.withColumn("own", F.coalesce("own", F.array().cast("array<struct<p:long,leaf:long,saved:long>>"))))
    blocks = held.where(F.col("length") > size).select(
        "conv_id", F.col("chunk").alias("b"), F.struct(rest("leaf", 0).alias("leaf"), rest("saved", 0).alias("saved")).alias("value")
    )
    graft = lambda c, left, right: both(c, F.coalesce(right, none))
    carry = _recurse(
        materialise(blocks), most, lambda a, b: both(a, F.coalesce(b, none)), graft, lambda c, left, right: c, none
    ).withColumnRenamed("b", "chunk")
    short = held.where(F.col("length") <= size).withColumn("carry", none)
    full = short.unionByName(held.where(F.col("length") > size).join(carry, ["conv_id", "chunk"]))
    sums = F.transform(
        F.sequence(F.lit(0), F.size("nodes") - 1),
        lambda p: F.struct(F.get("nodes", p).alias("node"), (rest("leaf", p) + F.col("carry.leaf")).alias("leaf"), (rest("saved", p) + F.col("carry.saved")).alias("saved")),
    )
    some = (F.size("own") > 0) | (F.col("carry.leaf") > 0) | (F.col("carry.saved") > 0)
    each = full.where(some).select(F.explode(sums).alias("x")).select("x.*")
    return each.groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _root_row(convs: DataFrame, nodes: DataFrame) -> DataFrame:
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    members = convs.select("conv_id", F.lit(1).cast("long").alias("conv"), zero.alias("child"), zero.alias("leaf"), zero.alias("saved"))
    parts = nodes.select(null.alias("conv_id"), zero.alias("conv"), (F.col("depth") == 1).cast("long").alias("child"), "leaf", "saved")
    total = members.unionByName(parts).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("conv", "child", "leaf", "saved")]
    )
    return total.where("conv > 0").select(
        _root().alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id", zero.alias("depth"), null.alias("parent_conv_id"),
        F.col("conv").alias("n_convs"), F.col("child").alias("n_children"),
        F.greatest("leaf", F.lit(1)).alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )


def hash_members(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the conv_ids of each node, ascending, joined by commas."""
    spread = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = spread.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(_pieces, "node binary, part long, piece long, ids string")
    together = pieces.repartition("node").sortWithinPartitions("node", "part", "piece")
    return together.select("node", "ids").mapInArrow(_hash_runs, "node binary, ends_sha256 string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node in a row as text, at most PIECE of them in a piece."""
    node, part, number, ids = None, 0, 0, []
    for batch in small_batches(batches, PIECE):
        out = []
        for here, conv_id, part in zip(*(batch.column(c).to_pylist() for c in ("node", "conv_id", "part"))):
            if here != node or len(ids) == PIECE:
                if ids:
                    out.append((node, part, number, ",".join(ids)))
                node, ids, number = here, [], number + 1
            ids.append(str(conv_id))
        if out:
            yield _rows(out)
    if ids:
        yield _rows([(node, part, number, ",".join(ids))])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["node", "part", "piece", "ids"])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, running = None, None
    done: list[tuple[bytes, str]] = []
    for batch in small_batches(batches):
        for here, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if here == node:
                running.update(b",")
            else:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = here, hashlib.sha256()
            running.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
            done = []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([running.hexdigest()])], ["node", "ends_sha256"])


def rebuild(numbered: DataFrame, every: int = REBUILT_FROM, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their ``every`` ids: (turns, convs) as ``prefix_trie`` takes them.

    Conversation c has the first h original turns of conversation c - c % every (all if it has fewer, none if it is
    absent), h being the CRC-32 of c's decimal digits modulo ``heads``, then its own turns after its first h.
    """
    convs = materialise(numbered.where("pos = 0").select("conv_id", "in_conv"))
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    wanted = convs.select("conv_id", "in_conv", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), head.alias("h"))
    bases = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("in_conv").alias("in_base"))
    taken = F.least("h", F.coalesce("in_base", F.lit(0)))
    plan = wanted.join(bases, "base", "left").withColumn("taken", taken)
    plan = materialise(plan.withColumn("length", F.col("taken") + F.greatest(F.col("in_conv") - F.col("h"), F.lit(0))))
    firsts = numbered.where((F.col("conv_id") % every == 0) & (F.col("pos") < heads))
    firsts = firsts.select(F.col("conv_id").alias("base"), "pos", "turn_name", "words")
    begin = plan.select("conv_id", "base", "h").join(firsts, "base").where("pos < h").select("conv_id", "pos", "turn_name", "words")
    own = numbered.withColumn("h", head).where("pos >= h")
    moved = plan.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"), F.col("in_conv").alias("_uses"))
    same = lookup(own, moved, "conv_id", own.count(), keep=True)
    rest = same.select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "turn_name", "words")
    return begin.unionByName(rest), plan.select("conv_id", "length")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    turns, convs = rebuild(number_turns(table(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie(turns, convs)
    hashed = nodes.join(hash_members(ends), "node", "left")
    return hashed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


ORACLE = f"""
WITH t AS (
    SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, turn,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) - 1 AS pos FROM t),
c AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % {REBUILT_FROM} AS base, {CRC32.format("conv_id::VARCHAR")} % {HEADS} AS h
    FROM t GROUP BY conv_id
),
k AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
s AS (
    SELECT k.conv_id, pos, item, words FROM k JOIN o ON o.conv_id = k.base AND pos < h
    UNION ALL
    SELECT k.conv_id, pos - h + taken, item, words FROM k JOIN o ON o.conv_id = k.conv_id AND pos >= h
),
p AS (SELECT *, string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM s),
m AS (
    SELECT conv_id, pos + 1 AS depth, prefix AS node, left(prefix, 64 * pos) AS parent, words FROM p
    UNION ALL
    SELECT conv_id, 0, '', NULL, 0 FROM c
),
e AS (SELECT conv_id, max_by(node, depth) AS node FROM m GROUP BY conv_id),
a AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM e GROUP BY node),
n AS (SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words FROM m GROUP BY node),
f AS (SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved FROM n LEFT JOIN f USING (node)),
u AS (
    SELECT m.node, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM w JOIN m ON m.conv_id = w.conv_id AND m.depth <= w.depth GROUP BY m.node
)
SELECT w.conv_id, w.depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM w JOIN u USING (node) LEFT JOIN w q ON q.node = w.parent LEFT JOIN a ON a.node = w.node
"""
