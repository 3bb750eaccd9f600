"""Positions in a global order, without a window over all rows or over a hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage


def numbered(rows: DataFrame, groups: list[str], order: list[Column], position: str = "position", partitions: int | None = None) -> DataFrame:
    """``rows`` with their 0-based ``position`` within their group (NULL is a group) in the given order.

    Rows are dealt to ranges of the whole order, so a group of any size spreads
    over many tasks; a row's position is its place in its range plus the rows of
    its group in earlier ranges.  Only one count per range and group is summed by
    window.  ``rows`` should be a written table: it is sampled for the ranges.
    Rows that tie in ``order`` are numbered in any order, but stay in one range
    unless ``order`` ends with something that tells them apart.
    """
    by = [*(F.col(g).asc_nulls_first() for g in groups), *order]
    ranges = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    placed = ranges.sortWithinPartitions(*by).withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    placed = stage(placed, "ranges")
    counts = stage(placed.groupBy("_range", *groups).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")), "range_counts")
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", *groups, (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_start"))
    found = attach(placed, starts, ["_range", *groups])
    return found.withColumn(position, F.col("_at") - F.col("_start")).drop("_range", "_at", "_start")
