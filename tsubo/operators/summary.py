"""Mean, confidence interval and correlation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.operators.profile import numeric_columns
from tsubo.sources.staging import stage


def confidence_interval(df: DataFrame, value: str, by: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Mean, margin and bounds: population deviation over the root of *all* rows, NULL ones included."""
    z = NormalDist().inv_cdf(1 - alpha / 2)
    grouped = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg(value).alias("mean"),
        (F.lit(z) * F.stddev_pop(value) / F.sqrt(F.count(F.lit(1)))).alias("margin"),
    )
    return grouped.withColumns({"lower": F.col("mean") - F.col("margin"), "upper": F.col("mean") + F.col("margin")})


def _correlation(x: Column, y: Column) -> Column:
    """Pearson r of the complete pairs; NULL where a side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


PAIR_STATE = ("n", "mx", "my", "xx", "yy", "xy")


def _pair_states(columns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task, for every pair of columns: count, means and centred products of its complete rows.

    Each batch is centred on its own complete rows and merged into the state,
    so no large sums cancel and a constant column has no spread at all.
    """
    i, j = np.triu_indices(columns, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mx, my, xx, yy, xy = np.zeros((6, len(i)))
        for batch in batches:
            data = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            there = [~np.isnan(c) for c in data]
            for pair, (a, b) in enumerate(zip(i, j, strict=True)):
                both = there[a] & there[b]
                x, y = data[a][both], data[b][both]
                if not len(x):
                    continue
                dx, dy = x - x[0], y - y[0]
                sx, sy = dx.mean(), dy.mean()
                dx, dy = dx - sx, dy - sy
                total = n[pair] + len(x)
                gap_x, gap_y = (x[0] + sx - mx[pair], y[0] + sy - my[pair]) if n[pair] else (0.0, 0.0)
                if not n[pair]:
                    mx[pair], my[pair] = x[0] + sx, y[0] + sy
                weight = n[pair] * len(x) / total
                xx[pair] += dx @ dx + gap_x * gap_x * weight
                yy[pair] += dy @ dy + gap_y * gap_y * weight
                xy[pair] += dx @ dy + gap_x * gap_y * weight
                mx[pair] += gap_x * len(x) / total
                my[pair] += gap_y * len(x) / total
                n[pair] = total
        seen = n > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(v[seen]) for v in (i, j, n, mx, my, xx, yy, xy)], names=["i", "j", *PAIR_STATE]
        )

    return run


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlations of the numeric columns, one row per pair (x before y).

    Hundreds of aggregate expressions in one plan compile and run far slower
    than numpy on Arrow batches, so each task sends one row per pair.  These
    rows are written and merged around the mean of each pair.  NULL where a
    side does not vary.
    """
    names = columns or numeric_columns(df)
    doubles = df.select(*(F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)))
    parts = doubles.mapInArrow(_pair_states(len(names)), "i BIGINT, j BIGINT, " + ", ".join(f"{c} DOUBLE" for c in PAIR_STATE))
    parts = stage(parts, "pairs")
    # one row per pair of columns: the means, measured from the least of them so that equal ones stay equal
    base = parts.groupBy("i", "j").agg(F.min("mx").alias("bx"), F.min("my").alias("by"))
    shift = parts.join(F.broadcast(base), ["i", "j"]).groupBy("i", "j", "bx", "by")
    shift = shift.agg(*(F.expr(f"b{s} + sum(n * (m{s} - b{s})) / sum(n)").alias(f"t{s}") for s in ("x", "y")))
    gaps = parts.join(F.broadcast(shift), ["i", "j"]).withColumns({"gx": F.expr("mx - tx"), "gy": F.expr("my - ty")})
    total = gaps.groupBy("i", "j").agg(*(F.expr(f"sum({a}{b} + n * g{a} * g{b})").alias(f"{a}{b}") for a, b in ("xx", "yy", "xy")))
    label = F.array(*map(F.lit, names))
    return total.select(
        F.get(label, F.col("i").cast("int")).alias("x"),
        F.get(label, F.col("j").cast("int")).alias("y"),
        F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("r"),
    )


def pearson_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r, complete pairs, t statistic and two-sided p of one pair of columns."""
    row = df.agg(
        _correlation(F.col(x), F.col(y)).alias("r"), F.regr_count(F.col(y), F.col(x)).alias("n")
    ).first()
    r, n = row["r"], row["n"]
    t = p = None
    if r is not None and n > 2:
        t = math.copysign(math.inf, r) if abs(r) >= 1 else r * math.sqrt((n - 2) / (1 - r * r))
        p = _two_sided_p(r, n)
    return df.sparkSession.createDataFrame([(x, y, n, r, t, p)], "x STRING, y STRING, n BIGINT, r DOUBLE, t DOUBLE, p DOUBLE")


def _gamma_ratio(a: float) -> float:
    """Gamma(a + 1/2) / Gamma(a): asymptotic series at a + 20, brought back by the recurrence."""
    far = a + 20
    ratio = math.sqrt(far) * math.exp(-1 / (8 * far) + 1 / (192 * far**3) - 1 / (640 * far**5) + 17 / (14336 * far**7))
    return ratio * math.prod((a + k) / (a + k + 0.5) for k in range(20))


def _two_sided_p(r: float, n: int) -> float:
    """P(|R| >= |r|) of n uncorrelated normal pairs, by the same quadrature for every n.

    With 1 - u^2 = (1 - r^2) exp(-s^2 / a), the tail of the density
    (1 - u^2)^(a - 1) is an integral of a smooth function times exp(-s^2).
    """
    a, rest = (n - 2) / 2, 1 - r * r
    if rest <= 0:
        return 0.0
    step = 1 / 64
    at = np.arange(-4, 4, step)
    s = np.exp(at - np.exp(-at))
    values = 2 * s * np.exp(-s * s) / np.sqrt(r * r - rest * np.expm1(-s * s / a))
    integral = float((values * s * (1 + np.exp(-at))).sum()) * step
    return min(1.0, math.exp(a * math.log1p(-r * r)) * _gamma_ratio(a) / (a * math.sqrt(math.pi)) * integral)
