"""Encoding, decoding and token files against the tokenizers library."""

import hashlib
import mmap
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clausewise.llm import automaton, bpe, token_files
from clausewise.llm.words import Vocabulary, WordEncoder
from clausewise.session import shared_dir

TEXT = bpe.read_tokenizer()
LIBRARY = Tokenizer.from_str(TEXT)
VOCABULARY = Vocabulary(TEXT)
ENCODER = WordEncoder(VOCABULARY, VOCABULARY.merge)
HARD = [
    "", " ", "Hello, wörld 12's don't WE'LL", "<|endoftext|>a<|startoftext|> b<|endoftext", "ΣΑΣ ΟΔΟΣ İstanbul",
    "a\x1cb\x1f c\x85d e　f", "é ́x å", "日本語テキスト 😀👍🏽 ½²Ⅷ٣", "aaa" * 400, "x" * 3000 + " " + "é" * 900,
    "tab\tnew\r\nline\x0b\x0c end", "...!!!???***", "'s 's't 'RE x'd", "\x00\x01�", "ǅ ﬁ ẞ ß",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", HARD)
def test_same_ids_and_text(text):
    ids = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
    assert ids == library(text)
    assert ENCODER.decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdeinrth  's.!éΣ\n"), st.characters(max_codepoint=0x2FF)), max_size=80))
def test_same_ids_random(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == library(text)


def test_short_and_long_merges_agree():
    for word in ("thereinthe", "aaaaaaab", "international" * 3):
        ids = [VOCABULARY.inner[b] for b in word.encode()]
        assert VOCABULARY._merge_long(ids[:]) == VOCABULARY._merge_short(ids[:])


def test_lexicon_shares_endings(tmp_path):
    words = sorted({a + b for a in (b"walk", b"talk", b"jump", b"") for b in (b"ing", b"ed", b"s")} | {"é".encode()})
    data = automaton.compile_words((w, [i, i + 1]) for i, w in enumerate(words))
    (tmp_path / "lex").write_bytes(data)
    lexicon = automaton.Lexicon.from_file(str(tmp_path / "lex"))
    assert isinstance(lexicon.data, mmap.mmap)
    assert [lexicon.rank(w) for w in words] == list(range(len(words)))
    assert all(list(lexicon.get(w)) == [i, i + 1] for i, w in enumerate(words))
    assert lexicon.get(b"walki") is None and lexicon.get(b"zzz") is None and lexicon.get(b"") is None
    assert lexicon.root < len(b"".join(words)) / 2
    empty = automaton.Lexicon(_mapped(tmp_path, automaton.compile_words([])))
    assert empty.get(b"a") is None


def _mapped(folder, data):
    (folder / "x").write_bytes(data)
    with open(folder / "x", "rb") as file:
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def frame(spark):
    rows = [(i, t, "en") for i, t in enumerate(HARD)] + [(100, None, "en"), (101, "a b", None), (None, "no id", "x")]
    return spark.createDataFrame(rows + [(102, "tie", "a"), (102, "tie", "b")], "doc_id long, text string, ids string")


@pytest.mark.parametrize("words", [3, 1000])
def test_round_trip(spark, words):
    docs = frame(spark)
    got = sorted(map(tuple, bpe.round_trip(docs, words=words).collect()), key=str)
    want = []
    for row in docs.collect():
        ids = library(row.text or "")
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((row.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode())))
    assert got == sorted(want, key=str)


def test_encode_then_decode(spark):
    docs = frame(spark)
    lexicon = bpe.ship(spark, bpe.build_lexicon(bpe.count_words(docs, "text", TEXT), TEXT))
    both = bpe.encode(docs, "text", "ids", TEXT, lexicon, "decoded")
    again = bpe.decode(bpe.encode(docs, "text", "ids", TEXT, lexicon), "ids", "decoded", TEXT)
    assert both.columns == again.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(str, both.collect())) == sorted(map(str, again.collect()))


def test_counts(spark):
    docs = spark.createDataFrame([("The cat, the CAT's <|endoftext|>hat",), (None,), ("",)], "text string")
    got = {r.word: r.n for r in bpe.count_words(docs, "text", TEXT).collect()}
    assert got == {"the": 2, "cat": 2, ",": 1, "'s": 1, "hat": 1}


def test_empty_tables(spark):
    docs = frame(spark).limit(0)
    assert bpe.round_trip(docs).count() == 0
    path = shared_dir(spark)
    token_files.write_segments(docs, path, TEXT)
    assert token_files.read_segments(spark, path).count() == 0


@pytest.mark.parametrize("segment_ids", [8, 1 << 20])
def test_token_files(spark, segment_ids):
    docs = frame(spark)
    path = shared_dir(spark)
    token_files.write_segments(docs, path, TEXT, segment_ids=segment_ids)
    got = sorted(map(tuple, token_files.read_segments(spark, path).collect()), key=lambda r: r[1])
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start, want = 0, []
    for row in rows:
        ids = [*library(row.text or ""), 2]
        want.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


@pytest.mark.parametrize("segment_ids", [40, 1 << 20])
def test_read_documents(spark, segment_ids):
    docs = frame(spark)
    path = shared_dir(spark)
    token_files.write_segments(docs, path, TEXT, segment_ids=segment_ids)
    wanted = docs.where("doc_id % 3 = 0").select("doc_id").union(spark.createDataFrame([(None,), (10**12,)], "doc_id long"))
    got = sorted((r.doc_id, r.ids) for r in token_files.read_documents(spark, path, wanted.union(wanted)).collect())
    rows = [r for r in docs.collect() if r.doc_id is not None and r.doc_id % 3 == 0]
    assert got == sorted((r.doc_id, [*library(r.text or ""), 2]) for r in rows) and got


@given(st.lists(st.integers(0, 5000), max_size=300))
@settings(max_examples=100, deadline=None)
def test_elias_fano(steps):
    values = np.cumsum(np.array(steps, np.int64))
    bits, low, high, samples = token_files.ef_encode(values)
    read = token_files.Boundaries(len(values), bits, low, high, samples)
    assert [read.select(k) for k in range(len(values))] == values.tolist() == list(read.all())
    places = np.array([*range(len(values)), *range(0, len(values), 7)], np.int64)
    assert read.select_many(places).tolist() == values[places].tolist()
    if len(values) > 200:
        assert len(low) + len(high) + len(samples) < 4 * len(values)
