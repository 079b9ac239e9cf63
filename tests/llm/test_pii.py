"""Spans against plain regular expressions and checks."""

import re
import time

import pytest

from clausewise.llm import pii
from clausewise.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [
    "", "a@b.co", "x@y.z_q@r.st,a@b", "a..b@c-d.e.f. mail me@@x.y @x.y", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.004 10.0.0.1",
    "card 4539 1488 0343 6467 and 4539-1488-0343-6468", "4539148803436467 12", "+49 (30) 1234-567 x +1 23", "+1" * 50, "+12345678",
    "é" * 7 + " pay 4539148803436467é +4930123456", "IBAN DE89 3704 0044 0532 0130 00 now", "iban DE89370400440532013001",
    "amex card 378282246310005", "378282246310005", "1" * 50000, "a" * 50000 + "@", "1." * 30000, "+1 " + " " * 50000, "GB82WEST12345698765432 bank",
]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, p, ok in kinds for m in re.finditer(p, text or "") if ok(m.group())
    )


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(1000 + i, t) for i, t in enumerate(ODD) if len(t) < 40000] + [(None, None), (None, "a@b.co"), (None, "a@b.co")]
    return table(spark, SF, "documents").select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))


def test_base_spans(docs):
    names = ["email", "ip", "card", "phone"]
    found = pii.find(docs)
    got = found.select("text", pii.joined(pii.F.filter("found", lambda x: x["kind"].isin(names))).alias("spans"))
    n = 0
    for r in got.collect():
        assert r.spans == base(r.text), r.text[:200]
        n += bool(r.spans)
    assert n > 10 and found.count() == docs.count()


def test_long_texts(spark):
    long = spark.createDataFrame([(t,) for t in ODD if len(t) >= 40000], "text string")
    got = [pii.joined(pii.F.col("found")) for _ in "x"]
    rows = pii.find(long).select("text", got[0].alias("s")).collect()
    for r in rows:
        if r.text.startswith("1."):
            assert r.s.startswith("ip:0:7,ip:8:15,") and r.s.count("ip") == 7500
        else:
            assert r.s == ""


def test_added_kinds(spark):
    rows = pii.find(spark.createDataFrame([(t,) for t in ODD if len(t) < 100], "text string")).collect()
    added = {x["value"] for r in rows for x in r.found if x["kind"] in ("iban", "short_card")}
    assert added == {"DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "378282246310005"}
    short = [r for r in rows if "378282246310005" in r.text]
    assert sorted(len(r.found) for r in short) == [0, 1]  # only with a context word
    plain = {r.text: x["score"] for r in rows for x in r.found if x["kind"] == "card"}
    assert max(plain.values()) == 1.0


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([("a@b.co", 1)], "text string, found int")
    assert pii.find(df).count() == 1
    assert pii.find(df.limit(0)).count() == 0


def test_bank_number_before_capitals(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 NOW PAY", "IBAN GB82WEST12345698765432 BANK 12", "IBAN NO93 8601 1117 947", "IBAN DE89 3704 0044 0532 0130 01 NOW",
        "IBAN DE89370400440532013000X",
    ]
    rows = pii.find(spark.createDataFrame([(t,) for t in texts], "text string")).select("text", pii.joined(pii.F.col("found")).alias("s")).collect()
    got = {r.text: [x for x in r.s.split(",") if x.startswith("iban")] for r in rows}
    assert [got[t] for t in texts] == [["iban:5:32"], ["iban:5:27"], ["iban:5:23"], [], []]


def test_very_many_numbers(spark):
    """200,000 matches in one text, in seconds; the places as a plain expression has them."""
    text = " x ".join(f"{i % 256}.1.2.{i % 300}" for i in range(200_000))
    begin = time.time()
    (row,) = pii.find(spark.createDataFrame([(text,)], "text string")).select(pii.joined(pii.F.filter("found", lambda x: x["kind"] == "ip")).alias("s")).collect()
    assert row.s == base(text) and time.time() - begin < 120


def test_context_before_a_match(spark):
    text = "ä call " + "12 " * 30 + " bank konto +4930123456 x+4930123457" + " " * 50 + "+4930123458, iban +4930123459"
    docs = spark.createDataFrame([(text,)], "text string")
    (row,) = pii.find(docs).collect()
    phones = [x for x in row.found if x.kind == "phone"]
    kind = next(k for k in pii.KINDS if k.name == "phone")
    for x in phones:
        near = text[max(0, x.start - pii.CONTEXT_CHARS) : x.start].lower()
        want = min(1.0, kind.score + (pii.CONTEXT if re.search(kind.context, near) else 0))
        assert abs(x.score - want) < 1e-9 and text[x.start : x.end] == x.value
    assert len(phones) == 4
