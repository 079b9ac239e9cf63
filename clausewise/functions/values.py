"""Column expressions for emptiness, coercion, rounding and ids.

All of them are built-in expressions, so they stay inside code generation and
work alike on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise import rules

# Every character that counts as blank (trim alone strips only U+0020).
BLANK_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLANKS = "".join(map(chr, BLANK_CODES))
# The leading range lets plain letters fail after two comparisons.
BLANK_RUN = (
    r"[\x09-\x{3000}&&[^\x21-\x7F]&&[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]+"
)
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def strip(c: Column) -> Column:
    """Text without blanks around it."""
    return F.btrim(c, F.lit(BLANKS))


def _stripped(name: str) -> Column:
    """A column as stripped text; what begins and ends with a printable ASCII letter is not looked into."""
    text = f"CAST(`{name}` AS STRING)"
    plain = " AND ".join(f"{end} >= '!' AND {end} < '\x7F'" for end in (text, f"substr({text}, -1)"))
    return F.expr(f"CASE WHEN {plain} THEN {text} ELSE btrim({text}, '{BLANKS}') END")


def text_of(c: Column) -> Column:
    """Value as text, stripped; null is ''."""
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def longest(words: Iterable[str]) -> int:
    """One letter more than the longest word: so much of a text tells whether it is one of them."""
    return max(map(len, words)) + 1


def _unless_empty(stripped: Column) -> Column:
    """Null for empty words; what has more bytes than any of them is not looked into."""
    long = F.octet_length(stripped) > max(map(len, rules.EMPTY_WORDS))
    return F.when(long, stripped).when(~F.lower(stripped).isin("", *rules.EMPTY_WORDS), stripped)


def _unless_empty_column(name: str) -> Column:
    words = ", ".join(f"'{word}'" for word in ["", *rules.EMPTY_WORDS])
    most = max(map(len, rules.EMPTY_WORDS))
    return F.expr(
        f"CASE WHEN octet_length(`{name}`) > {most} THEN `{name}` WHEN lower(`{name}`) NOT IN ({words}) THEN `{name}` END"
    )


def filled(c: Column) -> Column:
    """Value as stripped text, or null when it is empty or an empty word."""
    return _unless_empty(strip(c.cast("string")))


def with_filled(df: DataFrame, names: Iterable[str], prefix: str = "") -> DataFrame:
    """The named columns (those that exist) as filled text or null.

    Two steps, so that every column is stripped once however many fields read
    it.  With a prefix the originals stay and copies are added.
    """
    present = [name for name in dict.fromkeys(names) if name in df.columns]
    stripped = {prefix + name: _stripped(name) for name in present}
    df = df.withColumns(stripped)
    return df.withColumns({prefix + name: _unless_empty_column(prefix + name) for name in present})


def _found(df: DataFrame, names: Iterable[str], prefix: str) -> list[Column]:
    return [F.col(f"`{prefix}{name}`") for name in names if prefix + name in df.columns]


def first_of(df: DataFrame, names: Iterable[str], default: str = "", prefix: str = "") -> Column:
    """First value among the existing columns of a frame that went through ``with_filled``."""
    return F.coalesce(*_found(df, names, prefix), F.lit(default))


def joined_of(df: DataFrame, names: Iterable[str], sep: str = " ", prefix: str = "") -> Column:
    """The same for all values, joined; nulls vanish."""
    found = _found(df, names, prefix)
    return F.concat_ws(sep, *found) if found else F.lit("")


def clean(c: Column) -> Column:
    """Like ``filled`` with '' in place of null."""
    return F.coalesce(filled(c), F.lit(""))


def first_filled(df: DataFrame, names: Iterable[str], default: str = "") -> Column:
    """First filled value among the columns that exist; decided while planning."""
    present = [filled(F.col(f"`{name}`")) for name in names if name in df.columns]
    return F.coalesce(*present, F.lit(default))


def joined_filled(df: DataFrame, names: Iterable[str], sep: str = " ") -> Column:
    """The filled values of the columns that exist, joined; empty ones vanish."""
    present = [filled(F.col(f"`{name}`")) for name in names if name in df.columns]
    return F.concat_ws(sep, *present) if present else F.lit("")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True when one of the literal words occurs in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def contains_all(c: Column, words: Sequence[str]) -> Column:
    hit = F.lit(True)
    for word in words:
        hit = hit & c.contains(word)
    return hit


def to_number(c: Column) -> Column:
    """Text or number as double; anything else is null (never NaN)."""
    return F.regexp_extract(strip(c.cast("string")), NUMBER, 0).try_cast("double")


def number_in(df: DataFrame, name: str) -> Column:
    """Column as double or null; columns that are numbers already stay untouched."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    c = F.col(f"`{name}`")
    if is_numeric(df, name):
        return F.when(~F.isnan(c.cast("double")), c.cast("double"))
    return to_number(c)


def is_numeric(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType.simpleString()
    return kind in NUMERIC or kind.startswith("decimal")


def to_share(c: Column) -> Column:
    """Share in 0..1 of a stripped text: 85%, 85 and 0.85 are all 0.85, junk is 0."""
    number = F.regexp_extract(F.replace(c, F.lit("%"), F.lit("")), NUMBER, 0).try_cast("double")
    number = number / F.when(c.contains("%"), 100.0).otherwise(1.0)
    return F.coalesce(_share(number), F.lit(0.0))


def _share(number: Column) -> Column:
    return F.greatest(F.lit(0.0), F.when(number > 1.0, F.least(F.lit(1.0), number / 100.0)).otherwise(number))


def first_share(df: DataFrame, names: Iterable[str]) -> Column:
    """Share of the first filled column among those that exist; 0 without any.

    Text columns must have gone through ``with_filled``.
    """
    parts = []
    for name in (n for n in names if n in df.columns):
        c = F.col(f"`{name}`")
        share = _share(number_in(df, name)) if is_numeric(df, name) else to_share(c)
        parts.append(F.when(c.isNotNull(), share))
    return F.coalesce(*parts, F.lit(0.0))


def number_of(df: DataFrame, name: str) -> Column:
    """``to_number`` of a column; doubles and whole numbers don't become text on the way."""
    kind, c = df.schema[name].dataType.simpleString(), F.col(f"`{name}`")
    if kind == "double":
        return F.when(F.abs(c) < float("inf"), c)
    return c.cast("double") if kind in ("tinyint", "smallint", "int", "bigint") else to_number(c)


def flag_of(df: DataFrame, name: str) -> Column:
    """``is_flag`` of a column; booleans are taken as they are."""
    c = F.col(f"`{name}`")
    return F.coalesce(c, F.lit(False)) if df.schema[name].dataType.simpleString() == "boolean" else is_flag(c)


def is_flag(c: Column) -> Column:
    """Plain boolean words; null is false."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(rules.FLAG_WORDS), F.lit(False))


def is_demand(c: Column) -> Column:
    """Boolean words in both languages, and texts that name a demand; of stripped lower text."""
    return c.isin(rules.DEMAND_WORDS) | contains_any(c, rules.DEMAND_PARTS)


def severity_rank(c: Column) -> Column:
    """3 high, 2 medium high, 1 other, 0 empty; of stripped text."""
    return (
        F.when(contains_any(c, rules.HIGH_SEVERITY_WORDS), 3)
        .when(contains_any(c, rules.MEDIUM_SEVERITY_WORDS), 2)
        .when(c != "", 1)
        .otherwise(0)
    )


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the last bit of a double."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def fixed(c: Column, digits: int) -> Column:
    """Number printed with a fixed count of digits."""
    return F.round(c.cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})").cast("string")


#: Largest size that ``exact`` holds.
EXACT_BELOW = 1e17


def exact(c: Column) -> Column:
    """Number as a decimal of ten places, so that sums do not depend on the order of rows; null from EXACT_BELOW on."""
    return F.when(F.abs(c) < EXACT_BELOW, c.cast("decimal(28,10)"))


def total(c: Column) -> Column:
    """Sum over rows as a double: exact for usual numbers, and what is too large for that added as doubles."""
    large = F.sum(F.when(F.abs(c) >= EXACT_BELOW, c.cast("double")))
    return F.coalesce(F.sum(exact(c)).cast("double"), F.lit(0.0)) + F.coalesce(large, F.lit(0.0))


def mapped(c: Column, scores: Mapping[str, float], default: float) -> Column:
    """Score of a word in a small literal map."""
    out = F.lit(float(default))
    for word, score in reversed(list(scores.items())):
        out = F.when(c == word, float(score)).otherwise(out)
    return out


def hashed_id(prefix: str, c: Column, digits: int = 12) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(F.encode(c, "UTF-8")), 1, digits))


def node_id(prefix: str, c: Column) -> Column:
    """``Prefix:name`` with every other run of characters as one underscore."""
    text = clean(c)
    name = F.btrim(F.regexp_replace(text, r"[^0-9A-Za-z\x{4E00}-\x{9FFF}_.-]+", "_"), F.lit("_"))
    return F.when(text == "", "").otherwise(F.concat(F.lit(prefix + ":"), name))


def split_refs(c: Column, pattern: str) -> Column:
    """References in a text as a list; blanks around and empty parts go."""
    parts = F.transform(F.split(clean(c), pattern), strip)
    return F.filter(parts, lambda part: part != "")


REPORT_REF_BREAK = r"[；;]|\n+"
CLAUSE_REF_BREAK = r"[;；\n\r|]+"
