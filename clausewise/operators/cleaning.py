"""From the raw issue table to prepared and labelled issues."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise import rules
from clausewise.functions import text as t
from clausewise.functions import values as v
from clausewise.operators.numbering import number_rows, padded_id
from clausewise.session import materialise


def rename_issues(
    raw: DataFrame, columns: Mapping[str, str] = rules.RAW_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """Canonical column names; fails while planning when a source column is missing."""
    missing = [name for name in columns if name not in raw.columns]
    if missing:
        raise ValueError(f"missing columns in the raw table: {missing}")
    return raw.select(*keep, *[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def one_line(c: Column) -> Column:
    """Blanks of all kinds as single spaces, none at the ends; null is ''."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), v.BLANK_RUN, " "))


def known(line: Column) -> Column:
    """Text of one line, '' for empty words and the unknown mark."""
    words = [*rules.EMPTY_WORDS, rules.UNKNOWN]
    return F.when(F.lower(F.substring(line, 1, v.longest(words))).isin(words), "").otherwise(line)


def clean_text(c: Column) -> Column:
    """One line of single blanks; empty words and the unknown mark become ''."""
    return known(one_line(c))


#: Parts of a date format, the longest first, with the sign that stands for them in a shape.
FORMAT_PARTS = {
    "yyyyMMddHHmmss": "f", "yyyyMMdd": "e", "yyyy": "y", "MMM": "a", "'T'": "a", "yy": "d", "MM": "d", "dd": "d", "HH": "d",
    "hh": "d", "mm": "d", "ss": "d", "M": "d", "d": "d", "H": "d", "h": "d", "a": "a",
}
#: The same for what is written: words, then runs of digits by their length.
SHAPES = [("[A-Za-z]+", "a"), *((rf"(?<![0-9])[0-9]{{{n}}}(?![0-9])", sign) for n, sign in (("1,2", "d"), ("4", "y"), ("8", "e"), ("14", "f")))]


def shape_of_format(form: str) -> str:
    return re.sub("|".join(map(re.escape, FORMAT_PARTS)), lambda x: FORMAT_PARTS[x[0]], form)


def date_of(line: Column, formats: Sequence[str] = tuple(rules.DATE_FORMATS)) -> Column:
    """Date as yyyy-MM-dd; what is no date in any format stays as it is.

    Fractions of seconds, zones, weekdays and ordinal endings say nothing about the day that is
    written, and are taken off before; month names are cut to three letters. The shape of what is left (words
    and runs of digits by their length, other signs as they are) picks the format, so a value is parsed once and
    one of another shape not at all; formats of the same shape are tried in their order.
    """
    plain = F.regexp_replace(line, rules.DATE_TAIL, "$1")
    plain = F.regexp_replace(plain, rules.DATE_WEEKDAY, "")
    plain = F.regexp_replace(plain, rules.DATE_ORDINAL, "$1")
    plain = F.initcap(F.regexp_replace(plain, rules.DATE_MONTH, "$1"))
    plain = F.regexp_replace(plain, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})[Tt ] *", "$1 ")
    shape = plain
    for pattern, sign in SHAPES:
        shape = F.regexp_replace(shape, pattern, sign)
    by_shape: dict[str, list[str]] = {}
    for form in formats:
        by_shape.setdefault(shape_of_format(form), []).append(form)

    def parsed(x: Column) -> Column:
        out = F.lit(None).cast("timestamp")
        for known_shape, forms in by_shape.items():
            out = F.when(x["shape"] == known_shape, F.coalesce(*[F.try_to_timestamp(x["plain"], F.lit(f)) for f in forms])).otherwise(out)
        return F.date_format(out, "yyyy-MM-dd")

    # one element long, so that both parts are worked out once
    found = F.transform(F.array(F.struct(plain.alias("plain"), shape.alias("shape"))), parsed)
    # without a digit or above the longest spelling there is no date to look for
    may = line.rlike("[0-9]") & (F.length(line) <= rules.DATE_CHARS)
    return F.coalesce(F.when(may, F.get(found, F.lit(0))), line)


def clean_columns(df: DataFrame, texts: Sequence[str], dates: Sequence[str] = ()) -> DataFrame:
    """Clean text and date columns in steps, each value once per step."""
    df = df.withColumns({name: one_line(F.col(name)) for name in [*texts, *dates]})
    df = df.withColumns({name: known(F.col(name)) for name in [*texts, *dates]})
    return df.withColumns({name: date_of(F.col(name)) for name in dates})


def keep_valid(df: DataFrame, allowed: Sequence[str] = rules.LEVELS) -> DataFrame:
    """Rows with a text and an allowed label, before or after cleaning.

    Whether a text is empty shows at its ends, so filtering first spares the
    cleaning of rows that go anyway, and keeps it out of the scan's filter.
    """
    text = v.filled(F.col("text"))
    return df.filter(text.isNotNull() & (text != rules.UNKNOWN) & clean_text(F.col("label")).isin(list(allowed)))


def drop_repeats(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = rules.REPEAT_KEYS
) -> DataFrame:
    """First row per key; ``order_by`` is unique together.

    The keys of a row are one 128-bit digest, and the least order per digest is a hash aggregation of thin
    rows that every task does before the shuffle. The rows kept are then found by their order alone. The rows
    are written first, so that what made them (cleaning, mostly) is done once.
    """
    df = materialise(df)
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    digest = F.substring(F.sha2(F.concat(*[part(F.col(f"`{k}`").cast("string")) for k in keys]), 256), 1, 32)
    order = [F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order_by)]
    thin = df.select(digest.alias("_digest"), *order)
    if len(order) == 1:  # plain numbers stay in the hash table of the aggregation
        first = thin.groupBy("_digest").agg(F.min("_o0").alias("_o0")).select("_o0")
    else:
        least = F.min(F.struct(*[f"_o{i}" for i in range(len(order))]))
        first = thin.groupBy("_digest").agg(least.alias("_first")).select("_first.*")
    return df.join(first, [F.col(f"`{c}`").eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(order_by)], "left_semi")


def assign_ids(df: DataFrame, order_col: str, prefix: str = rules.ID_PREFIX) -> DataFrame:
    """Dense ids in row order as the first column."""
    numbered = number_rows(df, order_col, "_no")
    return numbered.select(padded_id(prefix, F.col("_no")).alias("sample_id"), *df.columns)


def prepare_issues(
    raw: DataFrame,
    order_col: str,
    *,
    columns: Mapping[str, str] = rules.RAW_COLUMNS,
    allowed: Sequence[str] = rules.LEVELS,
    data_source: str = rules.DATA_SOURCE,
) -> DataFrame:
    """Rename, clean, filter, drop repeats and number: the whole preparation."""
    named = rename_issues(raw, columns, keep=[order_col])
    texts = [name for name in columns.values() if name not in rules.DATE_COLUMNS]
    ready = clean_columns(keep_valid(named, allowed), texts, rules.DATE_COLUMNS)
    ready = ready.withColumns(
        {"source_unit": F.lit(rules.UNKNOWN), "data_source": F.lit(data_source)}
    )
    return assign_ids(drop_repeats(ready, [order_col]), order_col)


def category_of(
    df: DataFrame,
    category_rules: Sequence[Mapping] = tuple(rules.CATEGORY_RULES),
    default: str = rules.CATEGORY_DEFAULT,
    fields: Sequence[str] = tuple(rules.CATEGORY_TEXT_FIELDS),
) -> Column:
    """Category by the first rule with a true test."""

    def field(name: str) -> Column:
        return v.text_of(F.col(name)) if name in df.columns else F.lit("")

    everything = F.concat_ws(" ", *[F.nullif(field(name), F.lit("")) for name in fields])

    def holds(test: Mapping) -> Column:
        parts = []
        if "field" in test:
            parts.append(field(test["field"]).isin(list(test["values"])))
        if "words" in test:
            parts.append(v.contains_any(everything, test["words"]))
        return reduce(Column.__and__, parts)

    out = F.lit(default)
    for rule in reversed(category_rules):
        out = F.when(reduce(Column.__or__, map(holds, rule["tests"])), rule["category"]).otherwise(out)
    return out


def tagged(c: Column, tag: str) -> Column:
    """Data source with one more tag."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.concat(c, F.lit("|" + tag))).otherwise(tag)


def category_dataset(
    prepared: DataFrame,
    category_rules: Sequence[Mapping] = tuple(rules.CATEGORY_RULES),
    default: str = rules.CATEGORY_DEFAULT,
) -> DataFrame:
    """Prepared issues with the rule category as label; the level moves to its own column."""
    return prepared.withColumnRenamed("label", "problem_level").withColumns(
        {
            "label": category_of(prepared, category_rules, default),
            "data_source": tagged(F.col("data_source"), rules.CATEGORY_TAG),
        }
    )


def model_input(
    df: DataFrame,
    *,
    text_field: str = "text",
    fields: Sequence[str] = (),
    aliases: Mapping[str, str] | None = None,
    terms_map: dict[str, str] | None = None,
    key_sep: str = ": ",
    field_sep: str = "；",
    name_text: bool = True,
    skip_empty: bool = True,
    output: str = "model_input",
    **options: bool,
) -> DataFrame:
    """``alias: value；...；text alias: text`` of the normalised fields.

    The fields are normalised in place and once more inside the joined text, so
    a term map that feeds itself acts twice there.
    """
    aliases = aliases or {}
    present = [name for name in dict.fromkeys([text_field, *fields]) if name in df.columns]
    df = df.withColumns({name: t.normalised(F.col(name), terms_map, **options) for name in present})

    def value(name: str) -> Column:
        c = F.col(name) if name in df.columns else F.lit("")
        return t.normalised(c, terms_map, **options)

    def named(name: str) -> Column:
        return F.concat(F.lit(aliases.get(name, name) + key_sep), value(name))

    parts = [F.when(value(f) != "", named(f)) if skip_empty else named(f) for f in fields]
    last = named(text_field) if name_text else F.nullif(value(text_field), F.lit(""))
    return df.withColumn(output, F.concat_ws(field_sep, *parts, last))


def dataset_stats(
    raw: DataFrame, prepared: DataFrame, top_columns: Sequence[str] = ("specialty", "supervision_stage")
) -> DataFrame:
    """Long table (item, value, rows): row totals, labels, top ten of some columns.

    Every row of either table gives what it adds to each item, dropped rows being those of ``raw`` less those of
    ``prepared``, so one aggregation over one run of both gives all counts; they are written, and the tops taken from them.
    """
    entry = lambda item, rows, value=F.lit(""): F.struct(
        F.lit(item).alias("item"), value.cast("string").alias("value"), F.lit(rows).cast("bigint").alias("rows")
    )
    tops = {f"{c}_distribution_top10": c for c in top_columns}
    totals = [entry("raw_rows", 0), entry("prepared_rows", 0), entry("dropped_rows", 0)]  # there in empty tables, too
    given = [
        (raw.sparkSession.range(1), totals),
        (raw, [entry("raw_rows", 1), entry("dropped_rows", 1)]),
        (prepared, [
            entry("prepared_rows", 1), entry("dropped_rows", -1), entry("label_distribution", 1, F.col("label")),
            *(entry(item, 1, F.col(c)) for item, c in tops.items()),
        ]),
    ]
    parts = [df.select(F.inline(F.array(*entries))) for df, entries in given]
    counted = materialise(reduce(DataFrame.unionByName, parts).groupBy("item", "value").agg(F.sum("rows").alias("rows")))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("rows"), "value"))
    best = counted.where(F.col("item").isin(list(tops))).withColumn("_n", place).where("_n <= 10").drop("_n")
    return counted.where(~F.col("item").isin(list(tops))).unionByName(best)


def crosstab(
    df: DataFrame,
    categories: str = "label",
    levels: str = "problem_level",
    level_values: Sequence[str] = tuple(rules.LEVELS),
) -> DataFrame:
    """Rows per category, in total and per level."""
    return df.groupBy(F.col(categories).alias("category")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(levels) == level).alias(level) for level in level_values],
    )
