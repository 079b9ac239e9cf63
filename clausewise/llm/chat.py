"""Chat formatting by perspective (operator 10), native expressions only.

A conversation is rendered once for every participant: that speaker is the assistant, the others are
users with their names. The result has one row per (conversation, perspective, turn) with the
rendered piece, its place in the whole rendering and the part of it that is to be learned (the
assistant's own words and end mark), so no conversation has to fit into one row or task.
``render`` joins the pieces to one text where that is wanted.

Turns are ordered by (turn, role, text), nulls first; repeated rows stay. A null role is the
participant ``unknown``, a null text is empty. The role ``system`` is no participant: its turns are
shown to all, to be learned by none. A conversation without participants has no rendering.
A null conv_id is a conversation of its own.

Turns are range-partitioned in that order and written once with the number of their block, so a
block's turns are together, however long the conversation. Lengths are summed by block and
added up over blocks; turns are placed within their block alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.llm.common import table
from clausewise.session import materialise

END = "<|end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"


def head(role: Column, is_self: Column) -> Column:
    """What stands before a turn's text."""
    user = F.concat(F.lit("<|user name="), role, F.lit("|>\n"))
    return F.when(is_self, "<|assistant|>\n").when(role == SYSTEM, "<|system|>\n").otherwise(user)


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with key, block and place within the block; key is conv_id made safe for joins."""
    rows = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN)).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("key", F.when(F.col("conv_id").isNull(), "null").otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string"))))
    order = ["key", "turn", "role", "text"]
    spread = rows.repartitionByRange(*order).withColumn("block", F.spark_partition_id().cast("long"))
    return materialise(spread)


def perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, role, piece, start, end, learn_start, learn_end) for every turn and participant.

    turns has conv_id, turn, role and text. Places are code points, ends exclusive; a piece with
    nothing to learn has learn_start = learn_end = end.
    """
    rows = _ordered(turns)
    no_self, own = F.lit(False), F.lit(True)
    sized = rows.select(
        "key", "block", "role",
        F.length(F.concat(head(F.col("role"), no_self), "text", F.lit(END))).cast("long").alias("shown"),
        (F.length(head(F.col("role"), own)) - F.length(head(F.col("role"), no_self))).cast("long").alias("more"),
    )
    by_role = materialise(sized.groupBy("key", "block", "role").agg(F.sum("shown").alias("shown"), F.sum("more").alias("more")))
    by_block = by_role.groupBy("key", "block").agg(F.sum("shown").alias("shown"))
    speakers = by_role.where(F.col("role") != SYSTEM).select("key", F.col("role").alias("perspective")).distinct()
    own_part = by_role.select("key", "block", F.col("role").alias("perspective"), "more")
    blocks = by_block.join(speakers, "key").join(own_part, ["key", "block", "perspective"], "left")
    earlier = Window.partitionBy("key", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("shown") + F.coalesce("more", F.lit(0))
    begins = blocks.select(
        "key", "block", "perspective", F.coalesce(F.sum(size).over(earlier), F.lit(0)).cast("long").alias("begin")
    )
    shown = rows.join(begins, ["key", "block"])
    is_self = F.col("role") == F.col("perspective")
    first = head(F.col("role"), is_self)
    pieces = shown.select(
        "conv_id", "key", "block", "perspective", "turn", "role", "text", "begin", is_self.alias("own"),
        F.concat(first, "text", F.lit(END)).alias("piece"), F.length(first).cast("long").alias("head"),
    )
    here = Window.partitionBy("key", "block", "perspective").orderBy("turn", "role", "text")
    before = F.sum(F.length("piece")).over(here.rowsBetween(Window.unboundedPreceding, -1))
    placed = pieces.withColumn("start", (F.col("begin") + F.coalesce(before, F.lit(0))).cast("long"))
    placed = placed.withColumn("end", (F.col("start") + F.length("piece")).cast("long"))
    return placed.select(
        "conv_id", "perspective", "turn", "role", "piece", "start", "end",
        F.when(F.col("own"), F.col("start") + F.col("head")).otherwise(F.col("end")).alias("learn_start"),
        F.when(F.col("own"), F.col("end") - 1).otherwise(F.col("end")).alias("learn_end"),  # without the line's end
    )


def render(pieces: DataFrame) -> DataFrame:
    """(conv_id, perspective, text, learn): one text per rendering, for conversations that fit into a row."""
    item = F.struct("start", "piece", "learn_start", "learn_end")
    whole = pieces.groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(item)).alias("list"))
    learned = F.filter("list", lambda x: x["learn_start"] < x["learn_end"])
    return whole.select(
        "conv_id",
        "perspective",
        F.array_join(F.transform("list", lambda x: x["piece"]), "").alias("text"),
        F.transform(learned, lambda x: F.struct(x["learn_start"].alias("start"), x["learn_end"].alias("end"))).alias("learn"),
    )


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every rendering of all conversations."""
    return perspectives(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS n
    FROM conversations
),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
h AS (
    SELECT t.conv_id, perspective, turn, n, role, text,
           CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                ELSE '<|user name=' || role || '|>' END || chr(10) AS head
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
),
r AS (SELECT *, head || text || '<|end|>' || chr(10) AS piece FROM h),
s AS (
    SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY conv_id, perspective ORDER BY n) AS BIGINT) AS "end" FROM r
)
SELECT conv_id, perspective, turn, role, piece, "end" - length(piece) AS start, "end",
       CASE WHEN role = perspective THEN "end" - length(piece) + length(head) ELSE "end" END AS learn_start,
       CASE WHEN role = perspective THEN "end" - 1 ELSE "end" END AS learn_end
FROM s
"""
