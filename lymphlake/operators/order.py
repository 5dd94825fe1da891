"""Places of rows in a global order, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.plans.tables import written


def ranked(table: DataFrame, order: list[Column], column: str = "rank", first: int = 1) -> DataFrame:
    """``table`` with each row's place in ``order`` in ``column``, counted from ``first``.

    Spark samples the order and deals the rows to ranges; each range is sorted
    by itself and written, and the ranges' sizes give the offsets. One value
    that a third of the rows share spreads over several ranges as long as the
    order has further columns that tell rows apart; rows that it cannot tell
    apart stand in any order. Only the sizes, one row a range, are added up in
    one task.
    """
    rows = table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = written(rows, "ranked")
    sizes = rows.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + first
    return rows.join(offsets, F.shiftright("_at", 33) == F.col("_range")).withColumn(column, place).drop("_at", "_range", "_before")
