"""Near duplicates by fast similarity sketches, banding and exact checks (operator 3).

1. Documents with the same words in the same order are one class; its smallest doc_id
   stands for it.
2. Every class gets a sketch. In round i every shingle is thrown into a hashed bin with
   a hashed value; in the first t rounds into any bin, in the next t rounds all into bin i - t.
   A coordinate is the least (round, value) in its bin, and rounds end when no bin is
   empty, which 2t rounds guarantee. Sketches agree in a coordinate with the
   probability of the Jaccard similarity, with concentration bounds around it.
3. Equal bands of ``ROWS`` coordinates put classes in one bucket. Each is linked to the smallest of
   its buckets, if their full sets are similar enough.
4. What is still apart in some bucket is joined once more, on rare shingles: two
   sets of that similarity share one among the rarest of each, within known places.
   This looks at every remaining pair of a bucket without listing the pairs.

``BANDS`` times ``ROWS`` coordinates miss a link of similarity 0.75 with probability 2e-5,
others less. Documents without words are linked with nothing.
A null doc_id never stands for a class and is never kept together with others: each such row
is a component of its own. Repeated rows stay; classes whose smallest doc_id is the same one are one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.llm.common import components, small_batches, table
from clausewise.llm.shingles import BASE, mix, shared, shingle_set
from clausewise.session import materialise

BANDS, ROWS = 40, 5
SIZE = BANDS * ROWS
#: A link needs LINK_OUT_OF * intersection >= LINK * union.
LINK, LINK_OUT_OF = 75, 100
SEED = 0x5EED


def sketch(items: np.ndarray, size: int = SIZE) -> np.ndarray:
    """One coordinate per bin: hash of the least (round, value) that fell into it.

    The round stands in the upper bits, so several rounds are thrown at once.
    """
    empty = np.uint64(np.iinfo(np.uint64).max)
    best = np.full(size, empty, np.uint64)
    if not len(items):
        return best
    with np.errstate(over="ignore"):
        salts = mix(np.arange(SEED, SEED + 2 * size, dtype=np.uint64) * np.uint64(BASE))
        turn = 0
        while turn < size and (best == empty).any():
            turns = np.arange(turn, min(size, turn + 2 + 3 * size // len(items)), dtype=np.uint64)
            hashed = mix(items[None, :] ^ salts[turns][:, None])
            bins = (hashed >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)
            keys = (turns << np.uint64(48))[:, None] | mix(hashed) >> np.uint64(16)
            np.minimum.at(best, bins.ravel().astype(np.int64), keys.ravel())
            turn += len(turns)
        for i in np.flatnonzero(best == empty):  # the rounds that have one bin each
            least = mix(items ^ salts[size + i]).min()
            best[i] = np.uint64(size + i) << np.uint64(48) | least >> np.uint64(16)
        return mix(best)


def band_keys(items: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = sketch(items).reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mix(key * np.uint64(BASE) + rows[:, k])
    return key.view(np.int64)


def digest(text: str | None) -> str | None:
    """Of the word sequence, letters A-Z in lower case; None without words."""
    plain = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    return hashlib.sha256(plain).hexdigest()[:32] if plain else None


def _buckets(docs: DataFrame) -> DataFrame:
    """(doc_id, row, words, n_shingles, keys) per row; row is a digest of the text, keys are the band keys, none without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(2).to_pylist()
            sets = [shingle_set(x) for x in texts]
            keys = [band_keys(x) if len(x) else [] for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([digest(x) for x in texts], pa.string()),
                    pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "words", "n_shingles", "keys"],
            )

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return thin.mapInArrow(run, "doc_id long, row long, words string, n_shingles long, keys array<long>")


def _texts_of(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, row, text) of the documents that stand for the classes in heads."""
    thin = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("row"), "text")
    found = thin.join(heads, ["id", "row"]).groupBy("id", "row")  # a repeated row once
    return found.agg(F.first("text").alias("text"))


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets: dict[str, np.ndarray] = {}
            good = []
            for a, b, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                for text in (left, right):
                    if text not in sets:
                        sets[text] = shingle_set(text)
                both = shared(sets[left], sets[right])
                if LINK_OUT_OF * both >= LINK * (len(sets[left]) + len(sets[right]) - both):
                    good.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _rare_pairs(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may be similar, by their rarest shingles.

    Shingles are ordered by how many of these texts have them. With an intersection of
    at least need = ceil(3/7 (n + m)), the first shingle that two sets have in common lies at places p and q
    with min(n - p, m - q) >= need, and within the first n - ceil(3/4 n) + 1 of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(x) for x in batch.column(2).to_pylist()]
            sizes = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.repeat(batch.column(k).to_numpy(), sizes), pa.int64()) for k in (0, 1)),
                    pa.array(np.repeat(sizes, sizes), pa.int64()), pa.array(np.concatenate(sets).view(np.int64)),
                ],
                ["id", "row", "n", "shingle"],
            )

    items = materialise(texts.select("id", "row", "text").mapInArrow(run, "id long, row long, n long, shingle long"))
    common = items.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    # shingles of one text alone come first in its order and join with nothing
    held = items.join(common, "shingle").groupBy("id", "row", "n").agg(
        F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("list")  # one text's own shingles
    )
    need_own = F.ceil(F.col("n") * LINK / LINK_OUT_OF)
    first = F.slice("list", F.lit(1), F.greatest(F.lit(0), F.size("list") - need_own + 1).cast("int"))
    placed = held.select("id", "n", (F.col("n") - F.size("list")).alias("skip"), F.posexplode(first).alias("k", "x"))
    placed = placed.join(parts, "id").select(
        "id", "n", "component", (F.col("skip") + F.col("k")).alias("p"), F.col("x.shingle").alias("shingle")
    )
    left, right = placed.alias("l"), placed.alias("r")
    need = F.ceil((F.col("l.n") + F.col("r.n")) * LINK / (LINK + LINK_OUT_OF))
    room = F.least(F.col("l.n") - F.col("l.p"), F.col("r.n") - F.col("r.p"))
    on = (
        (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.id") < F.col("r.id"))
        & (F.col("l.component") != F.col("r.component")) & (room >= need)
    )
    return left.join(right, on).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, row, words, n_shingles, component_id, kept) of every row."""
    rows = materialise(_buckets(docs))
    known = rows.where("words is not null and doc_id is not null")
    head = F.min(F.struct("doc_id", "row")).alias("head")
    heads = known.groupBy("words").agg(head).select("words", F.col("head.doc_id").alias("id"), F.col("head.row").alias("row"))
    heads = materialise(heads)
    entries = rows.join(heads.select("words", F.col("id").alias("doc_id"), "row"), ["words", "doc_id", "row"])
    entries = entries.select(F.col("doc_id").alias("id"), F.explode("keys").alias("key")).distinct()
    lows = entries.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    crowded = materialise(entries.join(lows.select("key", "low"), "key"))
    stars = materialise(crowded.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct())
    texts = materialise(_texts_of(docs, heads.join(crowded.select("id").distinct(), "id", "left_semi")))
    links = materialise(similar(stars, texts))
    vertices = heads.select("id").distinct()
    parts = materialise(components(vertices, links))
    bucketed = crowded.join(parts, "id").groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_keys = bucketed.where("x < y").select("key")
    apart = crowded.join(open_keys, "key").select("id").distinct()
    rest = texts.join(apart, "id", "left_semi")
    more = materialise(similar(materialise(_rare_pairs(rest, parts)), rest))
    parts = components(vertices, links.union(more))
    named = heads.join(parts, "id").select("words", F.col("component").alias("component_id"))
    out = rows.drop("keys").join(named, "words", "left")
    component = F.when(F.col("doc_id").isNotNull() & F.col("words").isNotNull(), F.col("component_id"))
    out = out.withColumn("component_id", F.coalesce(component, "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stand for their component, with all columns; rows with equal doc_id and text are one document."""
    stay = link(docs).where("kept").select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct()
    same = F.col("_doc").eqNullSafe(docs["doc_id"].cast("long")) & (F.col("_row") == F.xxhash64(docs["text"]))
    return docs.join(stay.hint("merge"), same, "left_semi")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
