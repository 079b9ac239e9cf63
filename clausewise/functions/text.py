"""Tokens and similarity of short and long texts.

A text is prepared once (``tokens``) and then compared many times
(``similarity``).  Letter grams are held as numbers, so the set operations on
them use primitive hash sets.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import values as v

DOTTED_NUMBER = r"\p{Nd}+(?:\.\p{Nd}+)+"
WORD_CHARS = r"[\x{4E00}-\x{9FFF}A-Za-z0-9]+"
WORD_RUN = r"[\x{4E00}-\x{9FFF}A-Za-z0-9]{2,}"


def cleaned(c: Column) -> Column:
    """Lower case without dotted numbers and without all but letters, digits, CJK."""
    text = F.regexp_replace(F.lower(v.clean(c)), DOTTED_NUMBER, "")
    # the runs to keep, joined: replacing what stands between them costs ten times as much
    return F.array_join(F.regexp_extract_all(text, F.lit(WORD_CHARS), F.lit(0)), "")


def grams(clean_text: Column, n: int = 2) -> Column:
    """Distinct n-grams of an already cleaned text; a text up to n long is its own gram."""
    # One pass with a look-ahead: substring() would walk from the start each time.
    every = F.regexp_extract_all(clean_text, F.lit(f"(?=(.{{{n}}}))"), F.lit(1))
    return (
        F.when(clean_text.isin("", *rules.EMPTY_WORDS), F.array().cast("array<string>"))
        .when(F.length(clean_text) <= n, F.array(clean_text))
        .otherwise(F.array_distinct(every))
    )


def terms(c: Column) -> Column:
    """Distinct runs of two or more word characters of the lowered raw text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(v.clean(c)), F.lit(WORD_RUN), F.lit(0)))


def gram_codes(gram_list: Column) -> Column:
    """Bigrams as numbers: both code points side by side (each below 2**16)."""
    return F.transform(
        gram_list,
        lambda g: F.ascii(g).cast("bigint") * F.lit(65536)
        + F.ascii(F.substring(g, 2, 1)).cast("bigint"),
    )


def with_tokens(df: DataFrame, texts: Mapping[str, Column], n: int = 2) -> DataFrame:
    """Add a struct (clean, grams, terms) per text, as ``similarity`` compares them.

    Done in steps, so that every text is cleaned once however often the later
    steps refer to it.
    """
    df = df.withColumns({f"_{name}_low": c for name, c in texts.items()})
    df = v.with_filled(df, [f"_{name}_low" for name in texts])
    df = df.withColumns({f"_{name}_low": F.expr(f"lower(coalesce(_{name}_low, ''))") for name in texts})
    short = "array_join(regexp_extract_all(regexp_replace(_{0}_low, r'{1}', ''), r'{2}', 0), '')"
    df = df.withColumns(
        {f"_{name}_clean": F.expr(short.format(name, DOTTED_NUMBER, WORD_CHARS)) for name in texts}
    )

    def codes(name: str) -> Column:
        found = grams(F.col(f"_{name}_clean"), n)
        return gram_codes(found) if n == 2 else found

    out = {
        name: F.struct(
            F.col(f"_{name}_clean").alias("clean"),
            codes(name).alias("grams"),
            F.expr(f"array_distinct(regexp_extract_all(_{name}_low, r'{WORD_RUN}', 0))").alias("terms"),
        )
        for name in texts
    }
    return df.withColumns(out).drop(*[f"_{name}_{part}" for name in texts for part in ("low", "clean")])


def overlap(left: Column, right: Column) -> Column:
    """Jaccard share of two duplicate-free arrays; 0 when one is empty."""
    both = F.size(left) + F.size(right)
    # one element long, so that the shared size is worked out once and read twice
    shares = F.transform(F.array(F.size(F.array_intersect(left, right)).cast("double")), lambda n: n / (both - n))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(F.get(shares, F.lit(0)))


def similarity(left: Column, right: Column, weights: dict = rules.MATCH_RULES) -> Column:
    """Similarity in 0..1 of two ``tokens`` structs."""
    a, b = left["clean"], right["clean"]
    mixed = weights["gram_weight"] * overlap(left["grams"], right["grams"]) + weights[
        "term_weight"
    ] * overlap(left["terms"], right["terms"])
    return (
        F.when((a == "") | (b == ""), 0.0)
        .when(a.contains(b) | b.contains(a), float(weights["contained_score"]))
        .otherwise(v.rounded(mixed, 4))
    )


def keyword_hits(keywords: Column, text: Column) -> Column:
    """How many of the keywords occur in the text (case-sensitive)."""
    return F.size(F.filter(keywords, lambda word: (word != "") & text.contains(word)))


def normalised(
    c: Column,
    terms_map: dict[str, str] | None = None,
    *,
    strip: bool = True,
    lowercase: bool = False,
    punctuation: bool = True,
) -> Column:
    """Light normalisation: strip, lower, full-width marks to ASCII, ordered term map."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    if strip:
        text = v.strip(text)
    if lowercase:
        text = F.lower(text)
    if punctuation:
        text = F.translate(text, rules.FULL_WIDTH_MARKS, rules.ASCII_MARKS)
    for source, target in (terms_map or {}).items():
        text = F.replace(text, F.lit(source), F.lit(target))
    return text
