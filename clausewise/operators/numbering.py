"""Dense row numbers and ids without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise.functions import values as v
from clausewise.session import materialise


def number_rows(df: DataFrame, order_col: str, out: str = "row_no") -> DataFrame:
    """Number rows 1..n by a unique column of any ordered type.

    Order values are dealt into ranges of about equal size by their own distribution, so gaps between
    them do not matter.  The range of a value is written down with it; ranges are numbered on their
    own and shifted by the row counts of earlier ones.  Only those counts, one per range,
    meet in one task.  All of it works on the order column alone; the rows are joined once at the end.
    """
    ranges = df.select(order_col).repartitionByRange(F.col(order_col))
    thin = materialise(ranges.withColumn("_block", F.spark_partition_id()))
    counts = thin.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(F.col(order_col)))
    numbers = (
        thin.withColumn("_inside", inside)
        .join(starts, "_block")
        .select(order_col, (F.col("_start") + F.col("_inside")).cast("bigint").alias(out))
    )
    return numbers if df.columns == [order_col] else df.join(numbers, order_col)


def padded_id(prefix: str, number: Column) -> Column:
    """prefix + number padded to six digits; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits),
    )


def fill_ids(df: DataFrame, order_col: str, id_col: str = "sample_id", prefix: str = "pred") -> DataFrame:
    """Give rows without an id ``prefix_000001``..., counted among those rows only."""
    if id_col not in df.columns:
        numbered = number_rows(df, order_col, "_no")
        return numbered.withColumn(id_col, padded_id(prefix + "_", F.col("_no"))).drop("_no")
    missing = v.text_of(F.col(id_col)) == ""
    numbers = number_rows(df.filter(missing).select(F.col(order_col).alias("_order")), "_order", "_no")
    return (
        df.join(numbers, F.when(missing, F.col(order_col)) == F.col("_order"), "left")
        .withColumn(id_col, F.coalesce(padded_id(prefix + "_", F.col("_no")), F.col(id_col)))
        .drop("_order", "_no")
    )
