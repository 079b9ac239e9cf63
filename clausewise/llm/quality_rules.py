"""Quality rules with a hashed n-gram likelihood ratio (operator 7), native expressions only.

Base rules look at one text at a time. The ratio compares two multinomials over
``BUCKETS`` hashed one- and two-grams of letter, digit and symbol runs: one of trusted
documents (labelled as good), one of the whole corpus, both counted over all rows. A
document's score is the mean log ratio of its n-grams; it is kept if the base rules
pass and the score reaches the threshold, the same for every document.

A null or empty text has no words and fails the base rules. Rows are scored one by
one, so repeated ids and rows stay. A repeated label counts as good if any is.

Steps are projections of their own. A filter on a result column would be pushed
below them and repeat them, so write the result before filtering by it.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.llm.common import table

SPACE = r"[\x20\x09-\x0D]+"
BUCKETS = 10_000
#: Added to what a bucket has in the trusted documents, and to what it would have by its part of the corpus.
SMOOTHING = 1.0
#: Least mean log ratio of a document that is kept.
THRESHOLD = -0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda x: x != "")


def ngrams(tokens: Column) -> Column:
    """Buckets of all one- and two-grams of an array of token hashes."""
    one = F.transform(tokens, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    two = F.when(
        F.size(tokens) >= 2,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - 1),
            lambda i: F.pmod(F.xxhash64(F.get(tokens, i - 1), F.get(tokens, i)), F.lit(BUCKETS)).cast("int"),
        ),
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(one, two)


def token_hashes(text: Column) -> Column:
    """Hashes of runs of letters, digits and other signs."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}++|\p{N}++|[^\p{L}\p{N}\x20\x09-\x0D]++"), F.lit(0))
    return F.transform(runs, lambda x: F.xxhash64(x))


def repeated(windows: Column) -> Column:
    """(hash, place) of windows in order of the hash, if any hash occurs twice, else empty."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    distinct = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(distinct, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.array_sort(pairs))


def covered(ordered: Column) -> Column:
    """Words in windows that occur twice or more; ordered is a column of its own, as it is read at every step."""
    twice = F.filter(
        F.transform(
            ordered,
            lambda x, k: F.when(
                (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    return F.aggregate(
        F.array_sort(twice),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_words": words(whole), "_lines": lines})
    out = out.withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x)))
    hashes = F.col("_hashes")
    windows = F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_windows", windows).withColumn("_ordered", repeated(F.col("_windows")))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(whole, r"[^#*$%&|<>]++", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered(F.col("_ordered")),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return out.drop("_words", "_lines", "_hashes", "_windows", "_ordered").withColumn("base_failed", failed)


def bucket_weights(docs: DataFrame, labels: DataFrame) -> list[float]:
    """Log ratio of each bucket, trusted documents over all documents.

    docs has doc_id and text, labels doc_id and quality. The driver gets one row per
    bucket, at most ``BUCKETS``.
    """
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("trusted", F.lit(1))
    # sorted on both sides at every size, so that what a small table costs tells what a large one does
    marked = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    hashed = marked.select("trusted", token_hashes(F.coalesce("text", F.lit(""))).alias("tokens"))
    counts = (
        hashed.select("trusted", F.explode(ngrams(F.col("tokens"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target"))
        .collect()
    )
    all_raw = sum(row["raw"] for row in counts)
    share = sum(row["target"] for row in counts) / all_raw if all_raw else 0.0
    weights = [0.0] * BUCKETS
    for row in counts:
        ratio = (row["target"] + SMOOTHING) / (share * row["raw"] + SMOOTHING)
        weights[row["bucket"]] = round(math.log(ratio), 6)
    return weights


def mean_log_ratio(docs: DataFrame, weights: list[float], text: str = "text") -> DataFrame:
    """docs with log_ratio: the mean weight of a text's n-grams, 0 without any."""
    known = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded into one constant
    tokens = docs.withColumn("_tokens", token_hashes(F.coalesce(F.col(text), F.lit(""))))
    ratio = F.aggregate(
        ngrams(F.col("_tokens")),
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda a, b: F.struct((a["sum"] + F.get(known, b)).alias("sum"), (a["n"] + 1).alias("n")),
        lambda a: F.when(a["n"] > 0, F.round(a["sum"] / a["n"], 9)).otherwise(F.lit(0.0)),
    )
    return tokens.withColumn("log_ratio", ratio).drop("_tokens")


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All documents with their base numbers, mean log ratio and verdict."""
    weights = bucket_weights(docs, labels)
    rules = base_rules(docs.select("doc_id", "text"))
    scored = mean_log_ratio(rules, weights).drop("text")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
