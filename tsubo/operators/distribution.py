"""The data behind the charts: histogram, density curve, box plot and scatter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.operators.lookup import BROADCAST_BYTES, attach
from tsubo.operators.quantiles import quantiles
from tsubo.operators.ranking import numbered
from tsubo.sources.staging import stage

# Defaults of the charts.
GRID_POINTS = 200
WHISKER_IQRS = 1.5

# Of the fast Gauss transform: box width in units of sqrt(2) bandwidths, moments per box, boxes summed up at once.
BOX, TERMS, BOXES_AT_ONCE = 0.5, 16, 1000


class Bins(NamedTuple):
    """Even bins of a column and the rows in each that has any."""

    counts: DataFrame  # bin, count
    number: int
    low: float
    step: float
    rows: int

    def edge(self, bin: Column) -> Column:
        return F.lit(self.low) + bin * F.lit(self.step)

    def density(self, count: Column) -> Column:
        return count / F.lit(self.rows * self.step)


def _bins(df: DataFrame, value: str, **limits) -> Bins | None:
    """Automatic bins: the narrower of the Freedman-Diaconis and Sturges widths; every bin is half open but the last."""
    x = df.select(F.col(value).cast("double").alias("x")).na.drop()
    row = x.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    n, low, high = row["n"], row["low"], row["high"]
    if n == 0:
        return None
    q1, q3 = quantiles(x, [], "x", [0.25, 0.75], **limits).first()["quantiles"]
    span = high - low
    sturges = span / (math.log2(n) + 1)
    spread = 2 * (q3 - q1) * n ** (-1 / 3)
    width = min(spread, sturges) if spread > 0 else sturges
    bins = math.ceil(span / width) if width > 0 else 1
    if span == 0:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    # Rounding can put a value next to its bin: compare it with the borders.
    guess = F.least(F.floor((F.col("x") - low) / F.lit(step)), F.lit(bins - 1).cast("bigint"))
    below = F.col("x") < F.lit(low) + F.col("guess") * F.lit(step)
    above = (F.col("x") >= F.lit(low) + (F.col("guess") + 1) * F.lit(step)) & (F.col("guess") < bins - 1)
    place = F.when(below, F.col("guess") - 1).when(above, F.col("guess") + 1).otherwise(F.col("guess"))
    counts = x.withColumn("guess", guess).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return Bins(counts, bins, low, step, n)


def histogram_runs(df: DataFrame, value: str, **limits) -> DataFrame:
    """Density histogram whose runs of empty bins are one row each: ``bin, bins, bin_low, bin_high, count, density``.

    ``bin`` is the first and ``bins`` the number of bins of a row, 1 unless it is a run of empty ones.  There are at
    most two rows per value, however far the farthest value lies.
    """
    schema = "bin BIGINT, bins BIGINT, bin_low DOUBLE, bin_high DOUBLE, count BIGINT, density DOUBLE"
    found = _bins(df, value, **limits)
    if found is None:
        return df.sparkSession.createDataFrame([], schema)
    places = stage(numbered(stage(found.counts, "bins"), [], [F.col("bin")], "place"), "bin_places")
    later = places.select((F.col("place") - 1).alias("place"), F.col("bin").alias("next"))
    gap = places.join(later, "place").filter("next > bin + 1")
    gaps = gap.select((F.col("bin") + 1).alias("bin"), (F.col("next") - F.col("bin") - 1).alias("bins"), F.lit(0).cast("bigint").alias("count"))
    rows = places.select("bin", F.lit(1).cast("bigint").alias("bins"), "count").unionByName(gaps)
    return rows.select(
        "bin", "bins", found.edge(F.col("bin")).alias("bin_low"), found.edge(F.col("bin") + F.col("bins")).alias("bin_high"),
        "count", found.density(F.col("count")).alias("density"),
    )


def histogram(df: DataFrame, value: str, **limits) -> DataFrame:
    """The same with every bin listed, empty ones as well; a value far out makes that many rows."""
    found = _bins(df, value, **limits)
    if found is None:
        return df.sparkSession.createDataFrame([], "bin BIGINT, bin_low DOUBLE, bin_high DOUBLE, count BIGINT, density DOUBLE")
    count = F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    every = df.sparkSession.range(found.number).withColumnRenamed("id", "bin").join(found.counts, "bin", "left")
    return every.select(
        "bin", found.edge(F.col("bin")).alias("bin_low"), found.edge(F.col("bin") + 1).alias("bin_high"),
        count.alias("count"), found.density(count).alias("density"),
    )


def box_moments(u: np.ndarray, box: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct boxes and, per box, sum(weight * d^k / k!) for k < TERMS, with d the distance from the box's middle."""
    boxes, own = np.unique(box, return_inverse=True)
    d = u - (box + 0.5) * BOX
    sums, power = np.zeros((len(boxes), TERMS)), weight.astype(np.float64)
    for k in range(TERMS):
        sums[:, k] = np.bincount(own, power, len(boxes))
        power = power * d / (k + 1)
    return boxes, sums


def hermite_sums(at: np.ndarray, boxes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """At each place the sum of all kernels exp(-(place - u)^2), from the boxes' moments."""
    total = np.zeros(len(at))
    for i in range(0, len(boxes), BOXES_AT_ONCE):
        t = at[:, None] - (boxes[i : i + BOXES_AT_ONCE] + 0.5) * BOX
        before, now = np.zeros_like(t), np.exp(-t * t)
        for k in range(TERMS):
            total += now @ sums[i : i + BOXES_AT_ONCE, k]
            before, now = now, 2 * t * now - 2 * k * before
    return total


def density_curve(df: DataFrame, value: str, cut: float = 3.0, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid, with Scott's bandwidth.

    The grid reaches ``cut`` bandwidths beyond the data.  A fast Gauss transform:
    in units of sqrt(2) bandwidths, values are gathered in boxes of width
    ``BOX``; of a box only ``TERMS`` moments are kept, which are added up over the
    tasks, and its kernels are a Hermite series in them.  What the series leaves
    out is below 1e-13 of a kernel's height per value (Cramer's bound), so the density
    differs from the direct sum by less than 1e-13 of its greatest possible value.
    """
    x = df.select(F.col(value).cast("double").alias("x")).na.drop()
    row = x.agg(
        F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.stddev_samp("x").alias("std")
    ).first()
    n, low, std = row["n"], row["low"], row["std"]
    if n < 2 or not std:
        return df.sparkSession.createDataFrame([], "point BIGINT, x DOUBLE, density DOUBLE")
    h = std * n ** (-1 / 5)
    start, unit = low - cut * h, math.sqrt(2) * h
    step = (row["high"] + cut * h - start) / (points - 1)
    at = F.lit(start) + F.col("point") * F.lit(step)
    grid = (start + np.arange(points) * step - low) / unit
    names = [f"m{k}" for k in range(TERMS)]

    def gather(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            values, counts = np.unique(batch.column("x").to_numpy(), return_counts=True)
            u = (values - low) / unit
            boxes, sums = box_moments(u, np.floor(u / BOX), counts)
            yield pa.RecordBatch.from_arrays([pa.array(boxes.astype(np.int64)), *map(pa.array, sums.T)], ["box", *names])

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(points)
        for batch in parts:
            total += hermite_sums(grid, batch.column("box").to_numpy().astype(np.float64), np.column_stack([batch.column(m).to_numpy() for m in names]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points)), pa.array(total)], ["point", "total"])

    moments = x.mapInArrow(gather, "box BIGINT, " + ", ".join(f"{m} DOUBLE" for m in names)).groupBy("box").agg(*(F.sum(m).alias(m) for m in names))
    return (
        moments.mapInArrow(spread, "point BIGINT, total DOUBLE").groupBy("point").agg(F.sum("total").alias("total"))
        .select("point", at.alias("x"), (F.col("total") / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density"))
    )


def _fences(df: DataFrame, group: str, value: str, **limits) -> DataFrame:
    q = [F.get("quantiles", F.lit(i)) for i in range(3)]
    reach = F.lit(WHISKER_IQRS) * (q[2] - q[0])
    return quantiles(df, [group], value, [0.25, 0.5, 0.75], **limits).select(
        group, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - reach).alias("low_fence"), (q[2] + reach).alias("high_fence"),
    )


def _fenced(df: DataFrame, group: str, value: str, broadcast_bytes: int, **limits) -> DataFrame:
    """The rows' (group, value) cells with the fences of their group."""
    cells = df.select(group, F.col(value).cast("double").alias("value")).na.drop()
    fences = stage(_fences(cells, group, "value", **limits), "fences")
    return attach(cells, fences, [group], broadcast_bytes=broadcast_bytes)


def box_summary(df: DataFrame, group: str, value: str, broadcast_bytes: int = BROADCAST_BYTES, **limits) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``value`` per group.

    A whisker ends at the most extreme value within 1.5 interquartile ranges of
    its quartile.
    """
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    # A whisker never ends inside the box, even if no value lies there.
    return _fenced(df, group, value, broadcast_bytes, **limits).groupBy(group).agg(
        F.count(F.lit(1)).alias("count"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.least(F.min(F.when(inside, F.col("value"))), F.max("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col("value"))), F.max("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, group: str, value: str, broadcast_bytes: int = BROADCAST_BYTES, **limits) -> DataFrame:
    """Every distinct value beyond the fences of its group, with its number of rows."""
    beyond = ~F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return _fenced(df, group, value, broadcast_bytes, **limits).filter(beyond).groupBy(group, "value").agg(F.count(F.lit(1)).alias("n"))


def scatter(df: DataFrame, x: str, y: str) -> DataFrame:
    """The points of a scatter plot: all of them."""
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"))
