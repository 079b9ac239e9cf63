"""Token ids in binary segments with Elias-Fano document boundaries (operator 6).

Documents are range-partitioned and sorted by doc_id. A segment holds the ids of
consecutive documents end to end, as unsigned 16-bit integers if the vocabulary
allows (else 32-bit), and the place where each document ends as an Elias-Fano
sequence: low bits packed, high bits in unary, and the place of every 64th one
bit, from which select finds where a document begins and ends. A segment closes when it is full; only a single longer document makes a longer one.
Segments are rows of a Parquet table that Spark's writer commits, so retried tasks leave no trace
and any store that Spark writes to will do.

Ties of doc_id are ordered by text, a null doc_id comes first; a null or empty
text has the end id alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clausewise.llm.bpe import _vocabulary, read_tokenizer
from clausewise.llm.common import small_batches, table
from clausewise.llm.words import LETTERS, WordEncoder
from clausewise.session import shared_dir

END_ID = 2
SEGMENT_IDS = 1 << 20
#: Text a partition gets, by the size of the input, so that files have useful sizes at any scale.
PARTITION_BYTES = 16 << 20
SELECT_EVERY = 64
SCHEMA = (
    "part long, segment long, first_doc long, n_docs long, n_ids long, width int, doc_ids binary, "
    "low_bits int, low binary, high binary, samples binary, ids binary"
)

_encoders: dict = {}


def ef_encode(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Elias-Fano of an ascending sequence: low bit count, low bits, high bits, select samples."""
    n, top = len(ends), int(ends[-1]) if len(ends) else 0
    bits = max(0, (top // max(n, 1)).bit_length() - 1)
    ends = ends.astype(np.uint64)
    low = (ends[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    ones = (ends >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    return (
        bits,
        np.packbits(low.reshape(-1), bitorder="little").tobytes(),
        np.packbits(high, bitorder="little").tobytes(),
        ones[::SELECT_EVERY].astype("<u4").tobytes(),
    )


#: Ones in a byte, and the place of its k-th one.
_ONES = np.array([x.bit_count() for x in range(256)], np.int64)
_PLACE = np.array([([i for i in range(8) if x >> i & 1] + [0] * 8)[:8] for x in range(256)], np.int64)


class Boundaries:
    """Elias-Fano sequence with select."""

    def __init__(self, n: int, bits: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.n, self.bits = n, bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, k: int) -> int:
        """The k-th value: from the sample before it, on to the one bit, and its low bits."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        start = int(self.samples[k // SELECT_EVERY])
        left, byte = k % SELECT_EVERY, start // 8
        seen = int(self.high[byte]) >> start % 8 << start % 8
        while left >= (ones := seen.bit_count()):
            left -= ones
            byte += 1
            seen = int(self.high[byte])
        for _ in range(left):
            seen &= seen - 1
        one = 8 * byte + (seen & -seen).bit_length() - 1
        at = k * self.bits
        word = int.from_bytes(self.low[at // 8 : (at + self.bits + 7) // 8].tobytes(), "little")
        return (one - k) << self.bits | word >> at % 8 & (1 << self.bits) - 1

    def select_many(self, ks: np.ndarray) -> np.ndarray:
        """``select`` of many places at once: each from its sample on, byte by byte, all of them in step."""
        if not len(ks):
            return np.zeros(0, np.int64)
        start = self.samples[ks // SELECT_EVERY].astype(np.int64)
        left, byte = ks % SELECT_EVERY, start // 8
        seen = self.high[byte] >> (start % 8).astype(np.uint8) << (start % 8).astype(np.uint8)
        ahead = np.arange(len(ks))
        while len(ahead := ahead[left[ahead] >= _ONES[seen[ahead]]]):
            left[ahead] -= _ONES[seen[ahead]]
            byte[ahead] += 1
            seen[ahead] = self.high[byte[ahead]]
        one = 8 * byte + _PLACE[seen, left]
        at = ks.astype(np.int64) * self.bits
        low = np.concatenate([self.low, np.zeros(8, np.uint8)])
        word = np.zeros(len(ks), np.uint64)
        for i in range((self.bits + 14) // 8):
            word |= low[at // 8 + i].astype(np.uint64) << np.uint64(8 * i)
        word = word >> (at % 8).astype(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (one - ks << self.bits) + word.astype(np.int64)

    def all(self) -> np.ndarray:
        """All values at once, by unpacking every bit."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
        low = (low.astype(np.int64) << np.arange(self.bits)).sum(axis=1) if self.bits else 0
        return (ones - np.arange(self.n) << self.bits) + low


def _library_encoder(text: str) -> WordEncoder:
    """Words by the tokenizers library's own model, each once per worker."""
    if "library" not in _encoders or _encoders["library"][0] != text:
        model = Tokenizer.from_str(text).model

        def word_ids(word: str) -> list[int]:
            return [x.id for x in model.tokenize("".join([LETTERS[b] for b in word.encode()]))]

        _encoders["library"] = (text, WordEncoder(_vocabulary(text), word_ids))
    return _encoders["library"][1]


def _segment(part: int, number: int, docs: list, lengths: list[int], ids: list[bytes], width: int) -> pa.RecordBatch:
    ends = np.cumsum(np.array(lengths, np.int64))
    bits, low, high, samples = ef_encode(ends)
    values = np.frombuffer(b"".join(ids), "<u4")
    known = [x for x in docs if x is not None]
    row = {
        "part": part, "segment": number, "first_doc": known[0] if known else None, "n_docs": len(docs),
        "n_ids": len(values), "width": width,
        "doc_ids": pa.array(docs, pa.int64()).fill_null(0).to_numpy().astype("<i8").tobytes()
        + np.packbits([x is None for x in docs], bitorder="little").tobytes(),
        "low_bits": bits, "low": low, "high": high, "samples": samples,
        "ids": values.astype("<u2" if width == 2 else "<u4").tobytes(),
    }
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[name]], types[kind]) for name, kind in fields], [x[0] for x in fields])


def write_segments(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode (doc_id, text) and write the segments in ascending doc_id order."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer)
    width = 2 if max(_vocabulary(tokenizer).size, end_id + 1) <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _library_encoder(shipped.value), np.array([end_id], "<u4").tobytes()
        part, number, held, names, lengths, ids = 0, 0, 0, [], [], []
        for batch in small_batches(batches):
            for doc, text, part in zip(*(c.to_pylist() for c in batch.columns)):
                data = (encoder.encode(text) if text else b"") + end
                if names and held + len(data) // 4 > segment_ids:
                    yield _segment(part, number, names, lengths, ids, width)
                    number, held, names, lengths, ids = number + 1, 0, [], [], []
                names.append(doc)
                lengths.append(len(data) // 4)
                ids.append(data)
                held += lengths[-1]
        if names:
            yield _segment(part, number, names, lengths, ids, width)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spread = texts.repartitionByRange(_partitions(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    spread.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, SCHEMA).write.parquet(path)


def _partitions(docs: DataFrame) -> int:
    """By the planner's estimate of the input, without reading it."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = docs.sparkSession.sparkContext.defaultParallelism
    return int(min(max(least, size // PARTITION_BYTES + 1), 1 << 17))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; start counts all ids before the document."""
    segments = spark.read.parquet(path)
    # one row per segment, without its contents: a few bytes per million ids
    by_part = segments.groupBy("part").agg(F.sum("n_ids").alias("held"))
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = by_part.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    earlier = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = segments.select("part", "segment", F.coalesce(earlier, F.lit(0)).alias("earlier")).join(parts, "part")
    starts = starts.select("part", "segment", (F.col("part_start") + F.col("earlier")).alias("start"))
    columns = ["part", "segment", "n_docs", "width", "doc_ids", "low_bits", "low", "high", "samples", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            n = row["n_docs"]
            bounds = Boundaries(n, row["low_bits"], row["low"], row["high"], row["samples"])
            ends = bounds.select_many(np.arange(n))
            begins = np.concatenate([[0], ends[:-1]])
            null = np.unpackbits(np.frombuffer(row["doc_ids"], np.uint8, offset=8 * n), bitorder="little")[:n] == 1
            ids = np.frombuffer(row["ids"], f"<u{row['width']}")
            crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int64()), pa.array([row["segment"]] * n, pa.int64()),
                    pa.array(np.frombuffer(row["doc_ids"], "<i8", n), mask=null), pa.array(begins, pa.int64()),
                    pa.array(ends - begins, pa.int64()), pa.array(crc, pa.int64()),
                ],
                ["part", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )

    rows = segments.select(columns).mapInArrow(
        run, "part long, segment long, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents whose doc_id is in ``wanted``; only the segments that hold one are read.

    Every row that was written with such an id is returned; ids in ``wanted`` may repeat, null is none. Where a document
    begins and ends is found by select, without unpacking the segment.
    """
    segments = spark.read.parquet(path)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            n = row["n_docs"]
            null = np.unpackbits(np.frombuffer(row["doc_ids"], np.uint8, offset=8 * n), bitorder="little")[:n] == 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int64()), pa.array([row["segment"]] * n, pa.int64()),
                    pa.array(np.arange(n)), pa.array(np.frombuffer(row["doc_ids"], "<i8", n), mask=null),
                ],
                ["part", "segment", "k", "doc_id"],
            )

    thin = segments.select("part", "segment", "n_docs", "doc_ids").mapInArrow(places, "part long, segment long, k long, doc_id long")
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    found = thin.join(ids, "doc_id").groupBy("part", "segment").agg(F.collect_list("k").alias("ks"))  # of one segment

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            ks, n = np.sort(np.array(row["ks"], np.int64)), row["n_docs"]
            bounds = Boundaries(n, row["low_bits"], row["low"], row["high"], row["samples"])
            ends = bounds.select_many(ks)
            begins = np.where(ks > 0, bounds.select_many(np.maximum(ks - 1, 0)), 0)
            values = np.frombuffer(row["ids"], f"<u{row['width']}")
            names = np.frombuffer(row["doc_ids"], "<i8", n)[ks]
            lists = [values[a:b].astype(np.int64) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "ids"])

    held = segments.join(found, ["part", "segment"])
    columns = ["ks", "n_docs", "width", "doc_ids", "low_bits", "low", "high", "samples", "ids"]
    return held.select(columns).mapInArrow(cut, "doc_id long, ids array<long>")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents, read the files back."""
    path = shared_dir(spark)
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    write_segments(table(spark, sf_dir, "documents"), path, tokenizer)
    return read_segments(spark, path)
