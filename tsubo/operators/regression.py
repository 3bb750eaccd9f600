"""Least squares on numeric features plus one categorical feature.

A dummy per category and an intercept are the same model as one level per
category, so the slopes follow from the spread within categories and the
categories stay rows of a table, however many there are.

The slopes come from a tall-skinny QR: every task turns the rows of a fold and
category into a small triangular factor, factors are stacked and factored again
until one is left, and the slopes are solved from it.  No product of two
features is formed on the way, so nearly collinear features lose no more digits than
they must.  Counts, sums and cross products per test flag, fold and category,
from one more pass, give levels, deviations and scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage

TARGET = "rent"
NUMERIC = ["area", "building_age", "building_size", "floor"]
CATEGORY = "floor_plan"
# Singular values of the scaled factor below this share of the greatest are rounding errors of exact collinearity.
RANK_CUT = 1e-13
# Factors a task holds before it sends them on: some 300 bytes each.
FACTORS_HELD = 100_000


class Moments(NamedTuple):
    """Sums of centred values per (is_test, fold, category)."""

    table: DataFrame
    rows: DataFrame  # the centred rows themselves
    features: list[str]
    target: str
    category: str
    centre: dict[str, float]

    @property
    def variables(self) -> list[str]:
        return [*self.features, self.target]

    @property
    def sums(self) -> list[str]:
        return ["n", *(f"s_{v}" for v in self.variables), *(f"q_{a}_{b}" for a, b in self.pairs)]

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return list(combinations_with_replacement(self.variables, 2))


def complete_rows(df: DataFrame, features: list[str] = NUMERIC, target: str = TARGET, category: str = CATEGORY) -> DataFrame:
    """Rows a model can use: no missing feature, category or target."""
    return df.na.drop(subset=[*features, target, category])


def moments(split: DataFrame, features: list[str] = NUMERIC, target: str = TARGET, category: str = CATEGORY) -> Moments:
    """The sufficient sums; values are centred first so that squares stay small."""
    variables = [*features, target]
    row = split.agg(*(F.avg(v).alias(v) for v in variables)).first()
    centre = {v: row[v] for v in variables}
    centred = split.selectExpr("is_test", "fold", category, *(f"double(`{v}`) - {centre[v]!r}D AS `{v}`" for v in variables))
    table = centred.groupBy("is_test", "fold", category).agg(
        F.expr("count(1) AS n"),
        *(F.expr(f"sum(`{v}`) AS `s_{v}`") for v in variables),
        *(F.expr(f"sum(`{a}` * `{b}`) AS `q_{a}_{b}`") for a, b in combinations_with_replacement(variables, 2)),
    )
    return Moments(stage(table, "moments"), centred, features, target, category, centre)


# The formulas below are SQL text over the sums; ``prefix`` picks the rows the
# sums stand for and ``slopes`` holds a SQL operand per feature.


def _merged(factors: list[np.ndarray]) -> np.ndarray:
    """The triangular factor of all rows behind the given ones; its height is at most its width."""
    return np.linalg.qr(np.vstack(factors), mode="r")


def _partial_factors(width: int):
    """Factors of [1, features, target] per fold and category of a task's rows; a task with very many sends some early."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def sent() -> pa.RecordBatch:
            keys = list(held)
            columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], kind), pa.array([held[k].tobytes() for k in keys], pa.binary())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["fold", "category", "factor"])

        kind = pa.string()
        for batch in parts:
            kind = batch.column("category").type
            values = np.column_stack([np.ones(batch.num_rows), *(batch.column(i).to_numpy() for i in range(2, width + 1))])
            code = batch.column("category").dictionary_encode()
            names, fold = [*code.dictionary.to_pylist(), None], batch.column("fold").to_numpy()
            both = fold * len(names) + code.indices.fill_null(len(names) - 1).to_numpy()
            order = np.argsort(both, kind="stable")
            begin = np.flatnonzero(np.append(True, np.diff(both[order]) != 0)) if len(order) else []
            for rows in np.split(order, begin[1:]) if len(order) else []:
                key = (int(fold[rows[0]]), names[int(both[rows[0]]) % len(names)])
                held[key] = _merged([held[key], values[rows]] if key in held else [values[rows]])
            if len(held) > FACTORS_HELD:
                yield sent()
        yield sent()

    return work


def within_factors(m: Moments, leave_out: list[int | None]) -> dict[int | None, np.ndarray]:
    """Per fold left out (None: none of them) the factor of the other training rows, each variable about its category's mean.

    In the factor of [1, x, y] all rows but the first are the factor of x and y about their means: that is what goes on
    from every category.  A task keeps one factor per fold left out; the driver gets these.
    """
    width = len(m.variables) + 1
    train = m.rows.filter(~F.col("is_test")).select(F.coalesce("fold", F.lit(-1)).cast("bigint").alias("fold"), F.col(m.category).alias("category"), *(F.col(v).cast("double") for v in m.variables))
    kind = train.schema["category"].dataType.simpleString()
    parts = train.mapInArrow(_partial_factors(width), f"fold BIGINT, category {kind}, factor BINARY")

    def opened(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
        return [np.frombuffer(f).reshape(-1, width) for f in table.column("factor").to_pylist()]

    def per_category(table: pa.Table) -> pa.Table:
        fold, factors = table.column("fold").to_pylist(), opened(table)
        found = []
        for number, out in enumerate(leave_out):
            kept = [f for f, own in zip(factors, fold) if own != out]
            if kept:
                found.append((number, _merged(kept)[1:].tobytes()))
        return pa.table({"left_out": pa.array([n for n, _ in found], pa.int64()), "factor": pa.array([f for _, f in found], pa.binary())})

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, factor in zip(batch.column("left_out").to_pylist(), opened(batch)):
                held[number] = _merged([held[number], factor]) if number in held else factor
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([f.tobytes() for f in held.values()], pa.binary())], ["left_out", "factor"])

    schema = "left_out BIGINT, factor BINARY"
    rows = parts.groupBy("category").applyInArrow(per_category, schema).mapInArrow(per_task, schema).collect()
    total: dict[int | None, list[np.ndarray]] = {}
    for row in rows:
        total.setdefault(leave_out[row["left_out"]], []).append(np.frombuffer(row["factor"]).reshape(-1, width))
    return {out: _merged(factors)[:, 1:] for out, factors in total.items()}


def _solve(factor: np.ndarray | None, m: Moments) -> dict[str, float]:
    """Slopes from the factor of [features, target]; a feature that does not vary gets slope zero."""
    if factor is None or not len(factor):
        return dict.fromkeys(m.features, 0.0)
    x, y = factor[:, :-1], factor[:, -1]
    d = np.sqrt((x * x).sum(axis=0))
    d[d == 0] = 1.0
    slopes = np.linalg.lstsq(x / d, y, rcond=RANK_CUT)[0] / d
    return dict(zip(m.features, slopes.tolist(), strict=True))


def _first_category(m: Moments, prefix: str = "") -> Column:
    """Sums of the baseline: the first category in text order."""
    sums = ", ".join(f"`{prefix}{c}`" for c in ("n", *(f"s_{v}" for v in m.variables)))
    return F.expr(f"min_by(struct(`{m.category}`, {sums}), CASE WHEN `{prefix}n` > 0 THEN `{m.category}` END) AS first")


def _level_of(row, m: Moments, slopes: dict[str, float], prefix: str = "") -> float | None:
    """A category's level from its collected sums."""
    if not row[f"{prefix}n"]:
        return None
    fitted = sum(slopes[v] * row[f"{prefix}s_{v}"] for v in m.features)
    return (row[f"{prefix}s_{m.target}"] - fitted) / row[f"{prefix}n"]


def _level(m: Moments, slopes: dict[str, str], prefix: str = "") -> str:
    """Mean of target minus slopes per category, in centred units; NULL without rows."""
    fitted = " - ".join(f"{slopes[v]} * `{prefix}s_{v}`" for v in m.features)
    return f"try_divide(`{prefix}s_{m.target}` - {fitted}, `{prefix}n`)"


def _r2(m: Moments, slopes: dict[str, str], level: str, prefix: str = "") -> str:
    """1 - SSE / SST of the rows behind the sums."""
    t = m.target

    def q(a: str, b: str) -> str:
        return f"`{prefix}q_{a}_{b}`" if (a, b) in m.pairs else f"`{prefix}q_{b}_{a}`"

    rest = " - ".join([f"`{prefix}s_{t}`", *(f"{slopes[v]} * `{prefix}s_{v}`" for v in m.features)])
    squares = " + ".join(f"{slopes[a]} * {slopes[b]} * {q(a, b)}" for a in m.features for b in m.features)
    products = " + ".join(f"{slopes[v]} * {q(v, t)}" for v in m.features)
    sse = f"{q(t, t)} - 2 * ({products}) + {squares} - 2 * {level} * ({rest}) + {level} * {level} * `{prefix}n`"
    sst = f"sum({q(t, t)}) - try_divide(sum(`{prefix}s_{t}`) * sum(`{prefix}s_{t}`), sum(`{prefix}n`))"
    return f"1 - try_divide(sum({sse}), {sst})"


class Spread(NamedTuple):
    """Mean, population deviation and sample deviation."""

    mean: float
    population: float
    sample: float


class Fit(NamedTuple):
    """Slopes per feature; the level of a category follows from its sums."""

    moments: Moments
    cells: DataFrame  # one row per category: train_ and test_ sums
    slopes: dict[str, float]
    baseline: str
    baseline_level: float
    train: dict[str, Spread]
    test: dict[str, Spread]
    train_rows: int
    test_rows: int

    @property
    def level(self) -> str:
        return _level(self.moments, _literals(self.slopes), "train_")

    @property
    def dummy_deviation(self) -> str:
        """Population deviation of a category's dummy in the training rows."""
        share = f"train_n / {float(self.train_rows)!r}D"
        return f"sqrt({share} * (1 - {share}))"


def _literals(slopes: dict[str, float]) -> dict[str, str]:
    return {v: f"({s!r}D)" for v, s in slopes.items()}


def _spreads(row, m: Moments, prefix: str) -> dict[str, Spread]:
    n = row[f"{prefix}n"]
    found = {}
    for v in m.variables if n else []:
        mean = row[f"{prefix}s_{v}"] / n
        squares = max(row[f"{prefix}q_{v}_{v}"] - n * mean * mean, 0.0)
        found[v] = Spread(m.centre[v] + mean, (squares / n) ** 0.5, (squares / (n - 1)) ** 0.5 if n > 1 else 0.0)
    return found


def fit(m: Moments) -> Fit:
    """Fit on the training rows: one pass for the factors, one small job over the moments."""
    cells = m.table.groupBy(m.category).agg(
        *(F.expr(f"coalesce(sum(`{c}`) FILTER (WHERE NOT is_test), 0) AS `train_{c}`") for c in m.sums),
        *(F.expr(f"coalesce(sum(`{c}`) FILTER (WHERE is_test), 0) AS `test_{c}`") for c in m.sums),
    )
    row = cells.agg(
        *(F.expr(f"sum(`{c}`) AS `{c}`") for c in cells.columns if c != m.category),
        _first_category(m, "train_"),
    ).first()
    slopes = _solve(within_factors(m, [None]).get(None), m)
    return Fit(
        m, cells, slopes, row["first"][m.category], _level_of(row["first"], m, slopes, "train_"),
        _spreads(row, m, "train_"), _spreads(row, m, "test_"), row["train_n"], row["test_n"],
    )


def coefficients(f: Fit) -> DataFrame:
    """Coefficient on standardised features and sample deviation of the raw feature.

    ``per_unit`` divides the two for numeric features; a dummy is read against
    its baseline instead.
    """
    m = f.moments
    numeric = []
    for v in m.features:
        coefficient = f.slopes[v] * f.train[v].population
        numeric.append((v, coefficient, f.train[v].sample, coefficient / f.train[v].sample if f.train[v].sample else None))
    head = f.cells.sparkSession.createDataFrame(numeric, "feature STRING, coefficient DOUBLE, feature_std DOUBLE, per_unit DOUBLE")
    dummies = f.cells.filter((F.col("train_n") > 0) & (F.col(m.category) != f.baseline)).selectExpr(
        f"concat('{m.category}_', `{m.category}`) AS feature",
        f"({f.level} - {f.baseline_level!r}D) * {f.dummy_deviation} AS coefficient",
        f"{f.dummy_deviation} * {(f.train_rows / (f.train_rows - 1)) ** 0.5!r}D AS feature_std",
        "CAST(NULL AS DOUBLE) AS per_unit",
    )
    return head.unionByName(dummies)


class Refitted(NamedTuple):
    """The same coefficients applied to test rows scaled by their own mean and deviation."""

    slopes: dict[str, float]
    cells: DataFrame
    effect: str  # what a category adds; NULL for the baseline
    constant: float


def _refitted(f: Fit) -> Refitted:
    m = f.moments
    slopes, constant = {}, f.train[m.target].mean
    for v in m.features:
        slopes[v] = f.slopes[v] * f.train[v].population / (f.test[v].population or 1.0)
        constant -= slopes[v] * f.test[v].mean
    seen = f"test_n / {float(f.test_rows)!r}D"
    coefficient = f"({f.level} - {f.baseline_level!r}D) * {f.dummy_deviation}"
    # A dummy that does not vary among the test rows keeps divisor 1.
    divisor = f"CASE WHEN test_n > 0 AND test_n < {f.test_rows} THEN sqrt({seen} * (1 - {seen})) ELSE 1D END"
    effect = f"CASE WHEN train_n > 0 AND `{m.category}` <> first THEN {coefficient} / {divisor} END"
    cells = f.cells.withColumn("first", F.lit(f.baseline))
    shift = cells.agg(F.expr(f"coalesce(sum({effect} * {seen}), 0D)")).first()[0]
    return Refitted(slopes, cells, effect, constant - shift)


def predict(f: Fit, rows: DataFrame, refit_on_test: bool = False) -> DataFrame:
    """Adds ``predicted``; a category the training rows lack counts as the baseline.

    With ``refit_on_test`` the rows are the test rows, scaled by themselves.
    """
    m = f.moments
    if refit_on_test:
        slopes, cells, level, constant = _refitted(f)
        missing = 0.0
    else:
        slopes, cells, level, missing = f.slopes, f.cells, f.level, f.baseline_level
        constant = m.centre[m.target] - sum(slopes[v] * m.centre[v] for v in m.features)
    levels = stage(cells.selectExpr(f"`{m.category}`", f"{level} AS _level"), "levels")
    line = " + ".join(f"{slope} * `{v}`" for v, slope in _literals(slopes).items())
    value = F.expr(f"{constant!r}D + coalesce(_level, {missing!r}D) + {line}")
    return attach(rows, levels, [m.category]).withColumn("predicted", value).drop("_level")


def residuals(f: Fit, test: DataFrame, refit_on_test: bool = False) -> DataFrame:
    """Actual, predicted and residual = predicted - actual."""
    actual = F.col(f.moments.target)
    predicted = predict(f, test, refit_on_test)
    return predicted.select(actual.alias("actual"), "predicted", (F.col("predicted") - actual).alias("residual"))


def scores(f: Fit) -> DataFrame:
    """R2 of the training rows, the test rows, and the test rows scaled by themselves.

    All three come from the moments; no row is read again.
    """
    m = f.moments
    again = _refitted(f)
    # The refitted line in centred units.
    shift = again.constant - m.centre[m.target] + sum(again.slopes[v] * m.centre[v] for v in m.features)
    slopes = _literals(f.slopes)
    row = again.cells.selectExpr(
        "*",
        f"coalesce({f.level}, {f.baseline_level!r}D) AS level",
        f"coalesce({again.effect}, 0D) + {shift!r}D AS level_again",
    ).selectExpr(
        "sum(train_n) AS train_n",
        "sum(test_n) AS test_n",
        f"{_r2(m, slopes, 'level', 'train_')} AS train",
        f"{_r2(m, slopes, 'level', 'test_')} AS test",
        f"{_r2(m, _literals(again.slopes), 'level_again', 'test_')} AS again",
    )
    return row.selectExpr(
        "stack(3, 'train', train_n, train, 'test', test_n, test, 'test_refitted', test_n, again) AS (subset, n, r2)"
    )


def cross_validate(m: Moments) -> DataFrame:
    """Held-out R2 per fold: fit on the other folds, score on the fold.

    Training sums are a category's totals minus its sums in the fold; no row is
    read again.  A category has at most one entry per fold.
    """
    spark = m.table.sparkSession
    train = m.table.filter(~F.col("is_test"))
    folds = sorted(r[0] for r in train.select("fold").distinct().collect())
    own = ", ".join(f"`{c}`" for c in m.sums)
    per_category = train.groupBy(m.category).agg(
        F.expr(f"map_from_entries(collect_list(struct(fold, struct({own})))) AS by_fold"),
        *(F.expr(f"sum(`{c}`) AS `all_{c}`") for c in m.sums),
    )
    opened = per_category.selectExpr("*", f"explode(array({', '.join(map(str, folds))})) AS fold").selectExpr("*", "by_fold[fold] AS own")
    cells = opened.selectExpr(
        "fold", f"`{m.category}`",
        *(f"coalesce(own.`{c}`, 0) AS `{c}`" for c in m.sums),
        *(f"`all_{c}` - coalesce(own.`{c}`, 0) AS `rest_{c}`" for c in m.sums),
    )
    rest = cells.filter("rest_n > 0").groupBy("fold").agg(_first_category(m, "rest_"))
    factors = within_factors(m, folds)
    lines = []
    for row in rest.collect():
        slopes = _solve(factors.get(row["fold"]), m)
        lines.append((row["fold"], *(slopes[v] for v in m.features), _level_of(row["first"], m, slopes, "rest_")))
    names = [f"k_{v}" for v in m.features]
    line = spark.createDataFrame(lines, f"fold INT, {', '.join(f'{k} DOUBLE' for k in names)}, base DOUBLE")
    slopes = {v: f"`k_{v}`" for v in m.features}
    # One row per fold on this side.  Without training rows a category counts as the baseline.
    level = f"CASE WHEN rest_n > 0 THEN {_level(m, slopes, 'rest_')} ELSE base END AS level"
    scored = cells.join(F.broadcast(line), "fold").selectExpr("*", level)
    return scored.groupBy("fold").agg(F.expr("sum(n) AS n"), F.expr(f"{_r2(m, slopes, 'level')} AS r2"))


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 of one feature, in one aggregate."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_count(b, a).alias("n"),
        F.try_divide(F.covar_pop(a, b), F.var_pop(F.when(b.isNotNull(), a))).alias("slope"),
        F.covar_pop(a, b).alias("_c"), F.var_pop(F.when(b.isNotNull(), a)).alias("_v"),
        F.var_pop(F.when(a.isNotNull(), b)).alias("_w"), F.regr_avgx(b, a).alias("_x"), F.regr_avgy(b, a).alias("_y"),
    ).select(
        "n", "slope", (F.col("_y") - F.col("slope") * F.col("_x")).alias("intercept"),
        F.try_divide(F.col("_c") * F.col("_c"), F.col("_v") * F.col("_w")).alias("r2"),
    )


def cross_validate_simple(m: Moments, x: str) -> DataFrame:
    """Held-out R2 per fold of a one-feature model, from the same sums."""
    y = m.target
    q = lambda a, b: f"q_{a}_{b}" if (a, b) in m.pairs else f"q_{b}_{a}"
    names = {"n": "n", "sx": f"s_{x}", "sy": f"s_{y}", "xx": q(x, x), "xy": q(x, y), "yy": q(y, y)}
    folds = m.table.filter(~F.col("is_test")).groupBy("fold").agg(*(F.sum(c).alias(k) for k, c in names.items()))
    # One row per fold, so this window holds no more rows than there are folds.
    other = {k: F.sum(k).over(Window.partitionBy(F.lit(0))) - F.col(k) for k in names}
    rest = folds.withColumns({f"o_{k}": c for k, c in other.items()})
    o = {k: F.col(f"o_{k}") for k in names}
    slope = F.try_divide(o["xy"] - o["sx"] * o["sy"] / o["n"], o["xx"] - o["sx"] * o["sx"] / o["n"])
    line = rest.withColumn("b", F.coalesce(slope, F.lit(0.0))).withColumn("a", (o["sy"] - F.col("b") * o["sx"]) / o["n"])
    sse = F.expr("yy - 2 * a * sy - 2 * b * xy + n * a * a + 2 * a * b * sx + b * b * xx")
    return line.select("fold", "n", (1 - F.try_divide(sse, F.expr("yy - sy * sy / n"))).alias("r2"))
