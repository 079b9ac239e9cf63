"""Personal data: patterns propose, checksums confirm, context adjusts (operator 8), native only.

Patterns are written so that no text makes them backtrack over and over: runs are
possessive, and a run is tried at its start or where the last match ended.
Places come from the texts between the matches, which the same pattern splits off.

A null or empty text has no spans. Rows are treated one by one, so repeated ids stay.
Places are code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.llm.common import table

#: Code points before a span in which a context word counts.
CONTEXT_CHARS = 40
#: A span of an added kind needs this score.
MIN_SCORE = 0.6
CHECKSUM, CONTEXT = 0.3, 0.25
#: Matches whose places are found together.
CHUNK = 256


@dataclass(frozen=True)
class Kind:
    """pattern proposes, may says which texts can have it at all, confirm checks a match."""

    name: str
    pattern: str
    may: str
    context: str
    score: float
    base: bool = True


#: How long the bank numbers of a country are, by the public registry of IBAN formats.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A bank number as long as its country has them, so that words in capitals behind it are not taken in; those of
    other countries may have any length."""
    known = "|".join(c for countries in IBAN_LENGTHS.values() for c in countries.split())
    sized = [rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
    others = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(sized)}|{others})(?![A-Za-z0-9])"


_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = "[A-Za-z0-9-]++"
KINDS = [
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}(?:\.{_DOMAIN})++", "@", r"mail|contact|write", 0.8),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", r"\bip\b|host|server|addr", 0.6),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9](?:[\x20-]?+[0-9]){15}", r"card|visa|master|pay|credit", 0.5),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", r"phone|tel|call|mobile|fax", 0.6),
    Kind("iban", _iban(), r"[A-Z]{2}[0-9]{2}",
         r"iban|bank|account|konto|cuenta|compte", 0.4, False),
    Kind("short_card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9](?:[\x20-]?+[0-9]){12}", r"card|visa|amex|credit", 0.2, False),
]


def mod97(value: Column) -> Column:
    """Remainder by 97 of a bank number, letters as two digits, the first four signs last."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    return F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"),
    )


def confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "short_card":
        return F.length(digits).between(13, 15) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(value) == 1
    return F.lit(True)


def _confirm(kind: Kind):
    return lambda x: confirmed(kind.name, x["value"])


def _is(name: str):
    return lambda x: x["kind"] == name


def _hits(text: Column, kind: Kind) -> tuple[Column, Column]:
    """Matches of a kind and the texts between them."""
    may = F.contains(text, F.lit("@")) if kind.may == "@" else text.rlike(kind.may)
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(may, found).otherwise(none), F.when(may, F.split(text, kind.pattern, -1)).otherwise(none)


_SPANS = "array<struct<start:int,end:int,value:string,k:int>>"


def _chunks(hits: Column, gaps: Column) -> Column:
    """The matches in order, CHUNK of them at a time: (at, list), places from the begin of the chunk, at being its size.

    A list grows by one place at a time only within a chunk, so the work grows with the number of matches.
    """
    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("list"))

    def step(a: Column, k: Column) -> Column:
        start = a["at"] + F.length(F.get(gaps, k))
        end = start + F.length(F.get(hits, k))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), F.get(hits, k).alias("value"), k.alias("k")))
        return F.struct(end.alias("at"), F.concat(a["list"], one).alias("list"))

    def walk(c: Column) -> Column:
        return F.aggregate(F.sequence(c * CHUNK, F.least(c * CHUNK + CHUNK, F.size(hits)) - 1), first, step)

    numbers = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / CHUNK).cast("int"))
    none = F.array().cast(f"array<struct<at:int,list:{_SPANS}>>")
    return F.when(F.size(hits) > 0, F.transform(numbers, walk)).otherwise(none)


def _places(chunks: Column) -> Column:
    """(start, end, value, k) of the matches, in order."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("list"))
    begins = F.aggregate(
        chunks, first, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["list"], F.array(a["at"])).alias("list")), lambda a: a["list"]
    )
    moved = lambda x, at: F.transform(
        x["list"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value"), s["k"].alias("k"))
    )
    return F.flatten(F.zip_with(chunks, begins, moved))


def _before(hits: Column, gaps: Column, k: Column) -> Column:
    """The last CONTEXT_CHARS of the text before match k, put together from the matches and gaps before it.

    A match has two code points at least, so half as many of them as CONTEXT_CHARS reach as far; cutting
    the whole text for every match would take the square of its length.
    """
    end = lambda c: F.substring(c, -CONTEXT_CHARS, CONTEXT_CHARS)
    earlier = F.sequence(F.greatest(k - CONTEXT_CHARS // 2, F.lit(0)), k - 1)
    parts = F.transform(earlier, lambda j: F.concat(end(F.get(gaps, j)), F.get(hits, j)))
    return end(F.concat(F.when(k > 0, F.array_join(parts, "")).otherwise(""), end(F.get(gaps, k))))


def _scored(spans: Column, hits: Column, gaps: Column, kind: Kind) -> Column:
    checksum = CHECKSUM if kind.name in ("card", "iban", "short_card") else 0.0

    def score(x: Column) -> Column:
        near = F.lower(_before(hits, gaps, x["k"]))
        return F.struct(
            F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            F.least(F.lit(1.0), F.lit(kind.score + checksum) + F.when(near.rlike(kind.context), CONTEXT).otherwise(0.0)).alias("score"),
        )

    return F.transform(spans, score)


def find(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """docs with ``found``: an array of (kind, start, end, value, score), by kind as listed, then start.

    Spans of the base kinds stay whatever their score; spans of added kinds need min_score.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for kind in KINDS:
        hits, gaps = _hits(whole, kind)
        out = out.withColumns({f"_hits_{kind.name}": hits, f"_gaps_{kind.name}": gaps})
    out = out.withColumns({f"_chunks_{k.name}": _chunks(F.col(f"_hits_{k.name}"), F.col(f"_gaps_{k.name}")) for k in KINDS})
    out = out.withColumns({f"_at_{k.name}": F.filter(_places(F.col(f"_chunks_{k.name}")), _confirm(k)) for k in KINDS})
    parts = []
    for kind in KINDS:
        scored = _scored(F.col(f"_at_{kind.name}"), F.col(f"_hits_{kind.name}"), F.col(f"_gaps_{kind.name}"), kind)
        parts.append(scored if kind.base else F.filter(scored, lambda x: x["score"] >= min_score))
    out = out.withColumn("found", F.concat(*parts))
    return out.drop(*[f"_{part}_{kind.name}" for kind in KINDS for part in ("hits", "gaps", "chunks", "at")])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by kind, digest of the base spans and all spans of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    names = [kind.name for kind in KINDS if kind.base]
    counts = {f"n_{n}": F.size(F.filter("found", _is(n))).cast("long") for n in names}
    base = F.filter("found", lambda x: x["kind"].isin(names))
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )
