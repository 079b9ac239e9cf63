"""BPE encoding and decoding over a memory-mapped lexicon of frequent words (operator 2).

1. All texts are counted: how often each word occurs (partial counts in the tasks).
2. The frequent words are merged once and compiled into a minimal acyclic
   transducer, which Spark ships to each executor as a file; workers map it.
3. A text is encoded word by word: from the lexicon, or by exact merges if the
   lexicon does not have the word. Its size is a matter of speed only.

Ids are binary, little-endian unsigned 32-bit. A null or empty text has no ids and
decodes to an empty text. Strings of special tokens become their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from clausewise.llm import automaton
from clausewise.llm.common import small_batches, table
from clausewise.llm.words import Vocabulary, WordEncoder
from clausewise.session import materialise

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: A word is frequent if it is at least this part of all words, so the lexicon has at most so many words.
LEXICON_WORDS = 1_000_000
#: Distinct pieces a task holds while it counts.
COUNTED_AT_ONCE = 300_000

_open: dict = {}  # of this worker: what it has built, by content


def _vocabulary(text: str) -> Vocabulary:
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _open:
        _open[key] = Vocabulary(text)
    return _open[key]


def _encoder(text: str, lexicon_file: str) -> WordEncoder:
    key = ("encoder", lexicon_file)
    if key not in _open:
        for old in [x for x in _open if isinstance(x, tuple)]:
            del _open[old]
        vocabulary = _vocabulary(text)
        lexicon = automaton.Lexicon.from_file(SparkFiles.get(lexicon_file))

        def word_ids(word: str):
            found = lexicon.get(word.encode())
            return vocabulary.merge(word) if found is None else found

        _open[key] = WordEncoder(vocabulary, word_ids)
    return _open[key]


def count_words(texts: DataFrame, column: str, tokenizer: str) -> DataFrame:
    """(word, n) over all texts."""
    shipped = texts.sparkSession.sparkContext.broadcast(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pieces = WordEncoder(_vocabulary(shipped.value), lambda word: ()), Counter()
        for batch in small_batches(batches):
            encoder.count_pieces((x for x in batch.column(0).to_pylist() if x), pieces)
            if len(pieces) >= COUNTED_AT_ONCE:
                yield _counted(encoder.count_words(pieces))
                pieces = Counter()
        yield _counted(encoder.count_words(pieces))

    return texts.select(column).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
    )


def build_lexicon(counts: DataFrame, tokenizer: str, words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of all words that are at least one in ``words`` of all words."""
    kept = materialise(counts)
    total = kept.agg(F.sum("n")).first()[0] or 0
    frequent = kept.where(F.col("n") * words >= total).select("word").collect()
    vocabulary = _vocabulary(tokenizer)
    ordered = sorted((row["word"] for row in frequent), key=str.encode)
    return automaton.compile_words((word.encode(), vocabulary.merge(word)) for word in ordered)


def ship(spark: SparkSession, lexicon: bytes) -> str:
    """Give every executor the lexicon as a file; returns its name for SparkFiles.get."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="clausewise-lexicon-"), name)
    with open(path, "wb") as file:
        file.write(lexicon)
    spark.sparkContext.addFile(path)  # executors fetch it from the driver
    return name


def encode(
    docs: DataFrame, column: str, out: str, tokenizer: str, lexicon_file: str, decoded: str | None = None
) -> DataFrame:
    """docs with the ids of a text column in a binary column ``out``.

    With ``decoded``, also with the text that the ids decode to, made in the same pass.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)
    added = [StructField(out, BinaryType()), *([StructField(decoded, StringType())] if decoded else [])]
    rest = docs.drop(*(field.name for field in added))
    schema, at = StructType([*rest.schema.fields, *added]), rest.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped.value, lexicon_file)
        for batch in small_batches(batches):
            ids = [encoder.encode(x) if x else b"" for x in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([encoder.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return rest.mapInArrow(run, schema)


def decode(docs: DataFrame, column: str, out: str, tokenizer: str) -> DataFrame:
    """docs with the text of an id column in a string column ``out``."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)
    rest = docs.drop(out)
    schema, at = StructType([*rest.schema.fields, StructField(out, StringType())]), rest.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = WordEncoder(_vocabulary(shipped.value), lambda word: ())
        for batch in small_batches(batches):
            texts = [decoder.decode(x) if x else "" for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.fieldNames())

    return rest.mapInArrow(run, schema)


def read_tokenizer(path: str = TOKENIZER) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def round_trip(docs: DataFrame, path: str = TOKENIZER, words: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of all documents, with ids if they are to be kept."""
    spark, tokenizer = docs.sparkSession, read_tokenizer(path)
    lexicon = ship(spark, build_lexicon(count_words(docs, "text", tokenizer), tokenizer, words))
    return encode(docs.select("doc_id", "text"), "text", "ids", tokenizer, lexicon, "decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        *(["ids"] if keep_ids else []),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
