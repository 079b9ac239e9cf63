"""Benchmark decontamination by the q-gram lemma (operator 5).

A passage of m characters that stands in a text with at most k edits shares at
least m + 1 - q (k + 1) q-grams with it, all on diagonals within k of each other.
1. The q-grams of all benchmark items (a stated, bounded query set, shipped to every task)
   are held in one sorted table of 64-bit numbers: with q = 8 bytes a gram is its own key.
2. Every text is read once, whole. Hits are counted in diagonal bands that overlap, so any
   2k + 1 neighbouring diagonals lie within one band.
3. Regions whose count meets the bound are aligned: edit distance of the item to the best
   place on the band's diagonals, and no others.

Letters A-Z are compared in lower case and runs of white space as one space; lengths and
edits are in UTF-8 bytes of that form. k is a tenth of an item's length. Items too short for
the bound to be positive (at most 35 bytes) are looked up as they are.

A text that holds only a part of an item is found by the same lemma on windows of the item: ``WINDOW_BYTES``
bytes, one every ``WINDOW_STEP`` and one at the end, each with its own edits (a tenth of its length) and its own
aligned band. So any WINDOW_BYTES + WINDOW_STEP - 1 bytes in a row of an item are found, wherever they are.
Items shorter than a window have no parts. Null and empty items are ignored, null and empty texts have no passages. Rows are treated one by one, so repeated ids stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from clausewise.llm.common import small_batches, table

Q = 8
#: Edits allowed, in percent of an item's length.
EDIT_PERCENT = 10
#: Parts of items are found by windows of so many bytes, which begin at every so many bytes of an item.
WINDOW_BYTES, WINDOW_STEP = 64, 16
WINDOW_EDITS = WINDOW_BYTES * EDIT_PERCENT // 100
WINDOW_NEED = WINDOW_BYTES + 1 - Q * (WINDOW_EDITS + 1)
#: Benchmark items are a query set; more than this many bytes of them is refused, not cut.
MAX_BENCHMARK_BYTES = 256 << 20
#: Size of the table that tells which q-grams need a search; small enough to stay in a core's cache.
SLOT_BITS = 20
PARTS = ArrayType(StructType().add("item_id", LongType()).add("windows", IntegerType()))
PASSAGES = ArrayType(StructType().add("item_id", LongType()).add("edits", IntegerType()))


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def grams(data: bytes) -> np.ndarray:
    """Every q-gram of a text as a number, by place."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(data) - Q + 1,), "<u8", data, strides=(1,)).astype(np.uint64)


class Items:
    """Benchmark items, prepared for lookup."""

    def __init__(self, rows: list[tuple[int, bytes]]) -> None:
        self.ids = [x for x, _ in rows]
        self.texts = [x for _, x in rows]
        self.lengths = np.array([len(x) for x in self.texts], np.int64)
        self.edits = self.lengths * EDIT_PERCENT // 100
        self.need = self.lengths + 1 - Q * (self.edits + 1)
        self.short = [i for i in range(len(rows)) if self.need[i] <= 0]
        longer = [i for i in range(len(rows)) if self.need[i] > 0]
        parts = [grams(self.texts[i]) for i in longer]
        keys = np.concatenate([np.zeros(0, np.uint64), *parts])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = np.repeat(np.array(longer, np.int64), [len(x) for x in parts])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in parts)])[order]
        self.mask = np.zeros(1 << SLOT_BITS, bool)  # which hashes occur at all
        self.mask[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def hits(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of every common q-gram."""
        found = grams(data)
        at = np.flatnonzero(self.mask[self._slot(found)])
        low = np.searchsorted(self.keys, found[at], "left")
        n = np.searchsorted(self.keys, found[at], "right") - low
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else low
        return np.repeat(at, n), self.item[entry], self.place[entry]


def windows(length: int) -> list[int]:
    """Where the windows of an item begin."""
    last = length - WINDOW_BYTES
    return sorted({*range(0, last + 1, WINDOW_STEP), last}) if last >= 0 else []


def part_regions(items: Items, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int]]:
    """(item, start of the window, first diagonal of the item) of the bands whose count meets the windows' bound.

    All windows have the same edits, so the bands of an item do for each of its windows; only what lies in a band
    with enough hits for one window is dealt to windows.
    """
    text_at, item, place = hits
    some = (np.bincount(item, minlength=len(items.ids)) >= WINDOW_NEED)[item] & (items.lengths[item] >= WINDOW_BYTES)
    if not some.any():
        return []
    text_at, item, place = text_at[some], item[some], place[some]
    step = 2 * WINDOW_EDITS + 1
    band = (text_at - place + items.lengths[item]) // step
    item, place, band = np.tile(item, 2), np.tile(place, 2), np.concatenate([band, band - 1])
    order = np.lexsort((place, band, item))
    item, place, band = item[order], place[order], band[order]
    new_band = np.concatenate([[True], (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
    new_gram = new_band | np.concatenate([[True], place[1:] != place[:-1]])
    starts = np.flatnonzero(new_band)
    enough = np.add.reduceat(new_gram, starts) >= WINDOW_NEED
    stops = np.append(starts[1:], len(item))
    out = []
    for s, e in zip(starts[enough], stops[enough]):
        i = int(item[s])
        own = place[s:e][new_gram[s:e]]
        first = int(band[s]) * step - int(items.lengths[i])
        for at in windows(int(items.lengths[i])):
            low, high = np.searchsorted(own, (at, at + WINDOW_BYTES - Q + 1))
            if high - low >= WINDOW_NEED:
                out.append((i, at, first))
    return out


def regions(items: Items, data: bytes, hits: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int]]:
    """(item, first, last diagonal) of the bands whose count meets the bound, each once.

    A band spans 4k + 2 diagonals and begins every 2k + 1, so any 2k + 1 neighbours share one.
    Each q-gram of the item counts once in a band.
    """
    text_at, item, place = items.hits(data) if hits is None else hits
    # an item with fewer hits in the whole text than one band needs has no such band
    enough = np.bincount(item, minlength=len(items.ids)) >= items.need
    some = enough[item]
    if not some.any():
        return []
    text_at, item, place = text_at[some], item[some], place[some]
    width = 2 * items.edits[item] + 1
    band = (text_at - place + items.lengths[item]) // width
    item, place, band = np.tile(item, 2), np.tile(place, 2), np.concatenate([band, band - 1])
    order = np.lexsort((place, band, item))
    item, place, band = item[order], place[order], band[order]
    new_band = np.concatenate([[True], (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
    new_gram = new_band | np.concatenate([[True], place[1:] != place[:-1]])
    starts = np.flatnonzero(new_band)
    counts = np.add.reduceat(new_gram, starts)
    out = []
    for s, n in zip(starts, counts):
        i = int(item[s])
        if n >= items.need[i]:
            step = int(2 * items.edits[i] + 1)
            first = int(band[s]) * step - int(items.lengths[i])
            out.append((i, first, first + 2 * step - 1))
    return out


def banded(pattern: bytes, data: bytes, first: int, last: int, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best place of a pattern in a text on diagonals first to last, or None beyond most.

    Diagonal d pairs letter i of the pattern with letter i + d of the text. The place may begin anywhere on
    the band at no cost. One numpy row per letter of the pattern.
    """
    width = last - first + 1
    text = np.frombuffer(b"\0" * max(0, -first) + data + b"\0" * max(0, last + len(pattern) - len(data)), np.uint8)
    shift = max(0, -first)
    inf = len(pattern) + len(data) + width
    steps = np.arange(width)
    ends = first + steps  # text letters used before the first letter of the pattern, by diagonal
    row = np.where((ends >= 0) & (ends <= len(data)), 0, inf)
    for i, letter in enumerate(pattern):
        window = text[i + first + shift : i + first + shift + width]
        ends = first + steps + i + 1
        step = row + (window != letter)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)  # a letter of the pattern is missing in the text
        step[(ends < 1) | (ends > len(data))] = inf
        inside = (ends >= 0) & (ends <= len(data))
        step[:-1] = np.where(inside[:-1], np.minimum(step[:-1], row[1:] + 1), step[:-1])
        row = np.minimum.accumulate(step - steps) + steps  # letters of the text that the pattern lacks
        row[~inside] = inf
        if row.min() > most:
            return None
    best = int(row.argmin())
    return (int(row[best]), first + best + len(pattern)) if row[best] <= most else None


def passages(items: Items, text: str | None) -> list[tuple[int, int]]:
    """(item id, fewest edits) of the items that stand in a text, by id."""
    return whole_and_parts(items, text, False)[0]


def whole_and_parts(items: Items, text: str | None, with_parts: bool = True) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(item id, fewest edits) of the items that stand whole in a text, and (item id, windows) of those that only parts of do."""
    data = normal(text)
    hits = items.hits(data)
    found: dict[int, int] = {i: 0 for i in items.short if items.texts[i] in data}
    for i, first, last in regions(items, data, hits):
        if found.get(i) != 0:
            best = banded(items.texts[i], data, first, last, int(items.edits[i]))
            if best is not None:
                found[i] = min(best[0], found.get(i, best[0]))
    seen: set[tuple[int, int]] = set()
    for i, at, first in part_regions(items, hits) if with_parts else []:
        if i not in found and (i, at) not in seen:
            window = items.texts[i][at : at + WINDOW_BYTES]
            if banded(window, data, first + at, first + at + 4 * WINDOW_EDITS + 1, WINDOW_EDITS) is not None:
                seen.add((i, at))
    count: dict[int, int] = {}
    for i, _ in seen:
        count[i] = count.get(i, 0) + 1
    whole = sorted((items.ids[i], edits) for i, edits in found.items())
    return whole, sorted((items.ids[i], n) for i, n in count.items())


def read_items(benchmark: DataFrame) -> list[tuple[int, bytes]]:
    """The query set on the driver, after its size is checked; equal texts once, by smallest id."""
    kept = benchmark.where("item_id is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"benchmark items have {size} bytes, {MAX_BENCHMARK_BYTES} are allowed at once: pass them in parts")
    lowest: dict[bytes, int] = {}
    for row in kept.collect():
        data = normal(row["text"])
        if data:
            lowest[data] = min(row["item_id"], lowest.get(data, row["item_id"]))
    return sorted((i, data) for data, i in lowest.items())


def find(docs: DataFrame, benchmark: DataFrame, out: str = "passages", parts: str = "parts") -> DataFrame:
    """docs with an array of (item_id, edits), one for each item that stands whole in the text, and one of
    (item_id, windows) for those that only parts of do."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_items(benchmark))
    rest = docs.drop(out, parts)
    schema = StructType([*rest.schema.fields, StructField(out, PASSAGES), StructField(parts, PARTS)])
    at = rest.columns.index("text")
    kinds = [pa.list_(pa.struct([("item_id", pa.int64()), (name, pa.int32())])) for name in ("edits", "windows")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shipped.value)
        for batch in small_batches(batches):
            both = [whole_and_parts(items, text) for text in batch.column(at).to_pylist()]
            found = pa.array([[{"item_id": i, "edits": e} for i, e in whole] for whole, _ in both], kinds[0])
            some = pa.array([[{"item_id": i, "windows": n} for i, n in part] for _, part in both], kinds[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, found, some], schema.fieldNames())

    return rest.mapInArrow(run, schema)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items in it, whole and in part, and the verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        F.size("passages").cast("long").alias("n_items"),
        F.array_join(F.transform("passages", lambda x: F.concat_ws(":", x["item_id"], x["edits"])), ",").alias("items"),
        F.size("parts").cast("long").alias("n_parts"),
        F.array_join(F.transform("parts", lambda x: F.concat_ws(":", x["item_id"], x["windows"])), ",").alias("parts"),
        ((F.size("passages") == 0) & (F.size("parts") == 0)).alias("kept"),
    )
