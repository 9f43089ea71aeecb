"""Numbers and sums along a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.shared import written


def ranges(df: DataFrame, order: list[Column]) -> tuple[DataFrame, list[str]]:
    """df dealt to ranges of the order (nulls last), written so that the ranges are drawn once, with the range's number in
    `_range`; and the names of the columns that hold the order, to be dropped in the end."""
    named = {f"_o{k}": c for k, c in enumerate(order)}
    # Descending numbers are negated by the caller, so that ranges and order agree.
    dealt = df.withColumns(named).repartitionByRange(*(F.col(c).asc_nulls_last() for c in named)).withColumn("_range", F.spark_partition_id())
    return written(dealt, "ranges"), list(named)


def running_sum(df: DataFrame, order: list[Column], value: Column, into: str) -> DataFrame:
    """df with the sum of `value` over the rows up to each one in this order, which should be total.

    Each range is summed by itself; the ranges' totals, one row for each, give it its offset.
    """
    rows, names = ranges(df.withColumn("_v", value), order)
    totals = rows.groupBy("_range").agg(F.sum("_v").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    offsets = totals.select("_range", before.alias("_before"))
    upto = Window.partitionBy("_range").orderBy(*(F.col(c).asc_nulls_last() for c in names)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_here", F.sum("_v").over(upto)).join(offsets, "_range").withColumn(into, F.col("_here") + F.col("_before")).drop(*names, "_range", "_v", "_here", "_before")


def numbered(df: DataFrame, order: list[Column], into: str) -> DataFrame:
    """df with the rows' numbers from 1 in this order."""
    return running_sum(df, order, F.lit(1).cast("long"), into)
