"""Issue tables in CSV, JSON lines and Parquet."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Quotes are doubled inside quoted values, blanks at the ends are data.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
CSV_READ = {"multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_WRITE = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}
# Line breaks of texts as a backslash and a letter, so that a line is a row and many tasks can read one file.
BREAKS = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]
#: Rows of a compressed file at most.
ROWS_PER_FILE = 250_000
#: Rows of a piece of a table that is dealt out.
ROWS_PER_TASK = 500_000
KINDS = {".csv": "csv", ".jsonl": "jsonl", ".parquet": "parquet"}


def kind_of(path: str, file_type: str | None = None) -> str:
    kind = (file_type or KINDS.get(posixpath.splitext(path.rstrip("/"))[1].lower(), "")).lower()
    if kind not in KINDS.values():
        raise ValueError(f"unsupported table type: {file_type or path}")
    return kind


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    file_type: str | None = None,
    *,
    escaped_breaks: bool = False,
) -> DataFrame:
    """Read a table by suffix or given type.

    CSV from elsewhere may have line breaks inside quotes, which one task per file has to read. CSV that
    ``write_table`` wrote with escaped_breaks is split like any other text, and gets its line breaks back.

    Give a schema wherever the data is large: without one the columns of CSV
    are read as text and those of JSON lines are inferred by one extra pass.
    """
    kind = kind_of(path, file_type)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        df = reader.options(**CSV_OPTIONS, **{**CSV_READ, "multiLine": not escaped_breaks}).csv(path)
        return _on_texts(df, _with_breaks) if escaped_breaks else df
    if kind == "jsonl":
        return reader.json(path)
    return reader.parquet(path)


def _on_texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = [field.name for field in df.schema.fields if isinstance(field.dataType, StringType)]
    return df.withColumns({name: change(F.col(name)) for name in names})


def _without_breaks(c: Column) -> Column:
    for plain, escaped in BREAKS:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def _with_breaks(c: Column) -> Column:
    """An escaped backslash is set apart first, so that it never makes a break with the letter after it.

    Only texts with a backslash are looked into.
    """
    parts = F.split(c, r"\\\\")
    for plain, escaped in BREAKS[1:]:
        parts = _each(parts, escaped, plain)
    return F.when(c.contains("\\"), F.array_join(parts, "\\")).otherwise(c)


def _each(parts: Column, old: str, new: str) -> Column:
    return F.transform(parts, lambda x: F.replace(x, F.lit(old), F.lit(new)))


def write_table(
    df: DataFrame, path: str, file_type: str | None = None, *, escaped_breaks: bool = False, compression: str | None = None
) -> str:
    """Write a folder of part files, replacing what was there; parents are made.

    ``compression`` names a codec for CSV and JSON lines, which are several times as large as the same rows in columns. One
    task reads a compressed file, so none has more than ROWS_PER_FILE rows.
    """
    kind = kind_of(path, file_type)
    df = _on_texts(df, _without_breaks) if kind == "csv" and escaped_breaks else df
    writer = df.write.mode("overwrite")
    if compression and kind != "parquet":
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
    if kind == "csv":
        writer.options(**CSV_OPTIONS, **CSV_WRITE).csv(path)
    elif kind == "jsonl":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)
    return path


def with_position(df: DataFrame, out: str = "row_pos") -> DataFrame:
    """Place of a row in the files of a table, counted from 0 without gaps: the order that 'first' and 'last' refer to.

    Rows are numbered within their partition and shifted by the rows of earlier ones, of which there is one count
    per partition. The frame must come from files (or be deterministic), since it is read for the counts and for the rows.
    """
    part = F.shiftright("_id", 33)
    numbered = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", part)
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(earlier, F.lit(0)).alias("_start"))
    inside = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    placed = numbered.join(F.broadcast(starts), "_part")  # one row per partition
    return placed.withColumn(out, F.col("_start") + inside).drop("_id", "_part", "_start")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Deal out the rows of a table that comes in fewer files than there are cores.

    There are as many pieces as cores, and more if a piece had more than ROWS_PER_TASK rows otherwise, so that what a task
    groups doesn't grow with the table. Rows are counted from the footers of the files. Tables of many files pass through untouched.
    Rows that are joined by a ``key`` next are dealt out by it, so that they are shuffled once and not once more for the join.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(max(cores, -(-df.count() // ROWS_PER_TASK)), *([key] if key else []))
