import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsubo.operators import distribution, profile, summary
from tsubo.operators.quantiles import quantiles
from tsubo.sources.staging import stage

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot group of a third of the rows, one of equal values, a NULL group, NULL values."""
    random = np.random.default_rng(3)
    data = [("hot", float(v)) for v in random.lognormal(8, 2, 4000)]
    data += [("same", 7.0)] * 3000 + [(None, float(v)) for v in random.integers(0, 5, 2000)]
    data += [(f"g{i % 60}", float(v)) for i, v in enumerate(random.normal(0, 1, 3000))] + [("hot", None), ("single", 1.0)]
    return stage(spark.createDataFrame(data, "g STRING, x DOUBLE"), "skewed"), data


@pytest.mark.parametrize("limits", [{}, {"most_values": 20}, {"most_values": 20, "broadcast_bytes": 0}])
def test_grouped_quantiles_equal_numpy(skewed, limits):
    df, data = skewed
    got = {r["g"]: list(r["quantiles"]) for r in quantiles(df, ["g"], "x", PROBABILITIES, **limits).collect()}
    groups = {}
    for g, x in data:
        groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, values in groups.items():
        known = [v for v in values if v is not None]
        assert got[g] == pytest.approx(list(np.quantile(known, PROBABILITIES)), rel=1e-12), g


@pytest.mark.parametrize("name", ["bucket", "n", "place", "rank", "value"])
def test_group_columns_may_have_any_name(spark, name):
    df = stage(spark.range(100).select((F.col("id") % 2).alias(name), F.col("id").cast("double").alias("x")), "named")
    got = quantiles(df, [name], "x", [0.5], most_values=3)
    assert {r[name]: list(r["quantiles"]) for r in got.collect()} == {0: [49.0], 1: [50.0]}


def test_whole_table_quantiles(skewed):
    df, data = skewed
    known = [x for _, x in data if x is not None]
    got = quantiles(df, [], "x", [0.25, 0.75], most_values=50).first()["quantiles"]
    assert list(got) == pytest.approx(list(np.quantile(known, [0.25, 0.75])))


def test_quartiles_golden(spark):
    df = stage(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x DOUBLE"), "x")
    assert list(quantiles(df, [], "x", [0.25, 0.5, 0.75], most_values=2).first()["quantiles"]) == [1.75, 2.5, 4.75]


def test_histogram_equals_numpy(skewed):
    df, data = skewed
    known = np.array([x for g, x in data if x is not None and g != "hot"])
    got = distribution.histogram(stage(df.filter("g IS NULL OR g <> 'hot'"), "part"), "x", most_values=10)
    rows = got.orderBy("bin").collect()
    counts, edges = np.histogram(known, bins="auto")
    density, _ = np.histogram(known, bins="auto", density=True)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["bin_low"] for r in rows] + [rows[-1]["bin_high"]] == pytest.approx(edges.tolist())
    assert [r["density"] for r in rows] == pytest.approx(density.tolist())


def test_histogram_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x DOUBLE")
    assert [(r["bin"], r["count"], r["density"]) for r in distribution.histogram(df, "x").collect()] == [(0, 2, 1.0)]
    assert distribution.histogram(df.filter("x > 9"), "x").count() == 0


def test_density_curve(spark):
    values = np.random.default_rng(5).normal(10, 3, 500).round(1)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x DOUBLE")
    rows = distribution.density_curve(df, "x").orderBy("point").collect()
    grid, got = np.array([r["x"] for r in rows]), np.array([r["density"] for r in rows])
    h = values.std(ddof=1) * len(values) ** -0.2
    expected = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert got == pytest.approx(expected, rel=1e-9)
    assert np.trapezoid(got, grid) == pytest.approx(1, abs=0.01)
    assert grid[[0, -1]] == pytest.approx([values.min() - 3 * h, values.max() + 3 * h])
    on_data = distribution.density_curve(df, "x", cut=0.0).agg(F.min("x"), F.max("x")).first()
    assert tuple(on_data) == pytest.approx((values.min(), values.max()))


@pytest.mark.parametrize("limits", [{}, {"most_values": 20, "broadcast_bytes": 0}])
def test_box_summary_and_outliers(skewed, limits):
    df, data = skewed
    got = {r["g"]: r for r in distribution.box_summary(df, "g", "x", **limits).collect()}
    beyond = {}
    for r in distribution.box_outliers(df, "g", "x", **limits).collect():
        beyond.setdefault(r["g"], []).extend([r["value"]] * r["n"])
    assert None not in got
    for g in ("hot", "same", "g7", "single"):
        x = np.array([v for k, v in data if k == g and v is not None])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
        row = got[g]
        assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, q2, q3))
        assert (row["whisker_low"], row["whisker_high"]) == pytest.approx((x[inside].min(), x[inside].max()))
        assert row["outliers"] == (~inside).sum() and row["count"] == len(x)
        assert sorted(beyond.get(g, [])) == sorted(x[~inside])
        assert row["whisker_low"] <= row["q1"] <= row["median"] <= row["q3"] <= row["whisker_high"]


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5, None), (2.0, None, 5, None), (3.0, 5.0, 5, 1.0), (4.0, 4.0, 5, None)], "a DOUBLE, b DOUBLE, c INT, d DOUBLE"
    )
    found = {(r["x"], r["y"]): r["r"] for r in summary.correlation_matrix(df).collect()}
    assert found[("a", "b")] == pytest.approx(0.785714, abs=1e-6)
    assert found[("a", "c")] is None and found[("a", "d")] is None


def test_correlation_of_pairs_far_from_the_mean(spark):
    """The complete pairs of a and b lie far from where most of a lies."""
    random = np.random.default_rng(2)
    x = random.normal(0, 1, 200)
    y = x + random.normal(0, 0.5, 200)
    data = [(float(1e9 + a), float(b), 0.1) for a, b in zip(x, y)] + [(float(v), None, 0.1) for v in random.normal(0, 1, 2000)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, c DOUBLE").repartition(6)
    found = {(r["x"], r["y"]): r["r"] for r in summary.correlation_matrix(df).collect()}
    assert found[("a", "b")] == pytest.approx(np.corrcoef(1e9 + x, y)[0, 1], rel=1e-6)
    assert found[("a", "c")] is None and found[("b", "c")] is None


def test_correlation_equals_numpy(spark):
    x = np.random.default_rng(1).normal(1e6, 1, (500, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a DOUBLE, b DOUBLE, c DOUBLE").repartition(5)
    found = {(r["x"], r["y"]): r["r"] for r in summary.correlation_matrix(df).collect()}
    expected = np.corrcoef(x.T)
    assert [found[k] for k in (("a", "b"), ("a", "c"), ("b", "c"))] == pytest.approx(expected[[0, 0, 1], [1, 2, 2]], rel=1e-9)


def test_pearson_p_value(spark):
    # Student t with 8 degrees of freedom: P(|T| > 2.306004) = 0.05.
    t = 2.306004135204166
    r = t / math.sqrt(8 + t * t)
    assert summary._two_sided_p(r, 10) == pytest.approx(0.05, rel=1e-9)
    assert summary._two_sided_p(0.0, 10) == pytest.approx(1.0, abs=1e-12) and summary._two_sided_p(1.0, 10) == 0.0
    # Closed forms with one and two degrees of freedom.
    for t in (1e-6, 0.3, 4.0, 50.0):
        assert summary._two_sided_p(t / math.sqrt(1 + t * t), 3) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-9)
        assert summary._two_sided_p(t / math.sqrt(2 + t * t), 4) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)
    # One more row hardly moves it, also far out, and the normal limit is approached.
    for z in (0.5, 1.959963984540054, 10.0, 30.0):
        p = [summary._two_sided_p(z / math.sqrt(n - 2 + z * z), n) for n in (10_000_000, 10_000_001)]
        assert p[0] == pytest.approx(p[1], rel=1e-5)
        n = 10**13
        assert summary._two_sided_p(z / math.sqrt(n - 2 + z * z), n) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-7)
    row = summary.pearson_test(spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, None)], "x DOUBLE, y DOUBLE"), "x", "y").first()
    assert (row["n"], row["r"], row["p"]) == (3, pytest.approx(1.0), pytest.approx(0.0, abs=1e-6))


def test_confidence_interval_counts_missing_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x DOUBLE")
    row = summary.confidence_interval(df, "x").first()
    deviation = 1.247219128924647
    assert row["sample_size"] == 4 and row["mean"] == pytest.approx(7 / 3)
    assert row["margin"] == pytest.approx(1.959963984540054 * deviation / 2)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (4, "b", 3.0), (None, "a", 4.0), (9, None, 5.0)], "i BIGINT, t STRING, d DOUBLE")
    assert [tuple(r) for r in profile.column_profile(df).collect()] == [("i", 4, "bigint"), ("t", 4, "string"), ("d", 4, "double")]
    text = profile.describe_text(df).first()
    assert (text["count"], text["unique"], text["top"], text["freq"]) == (4, 2, "a", 2)
    number = {r["column_name"]: r for r in profile.describe_numeric(df).collect()}["i"]
    assert (number["count"], number["mean"], number["min"], number["max"], number["q50"]) == (4, 4.0, 1.0, 9.0, 3.0)
    assert number["std"] == pytest.approx(np.std([1, 2, 4, 9], ddof=1))


@pytest.mark.parametrize("seed", [1, 2])
def test_fast_gauss_sums_equal_direct_ones(seed):
    random = np.random.default_rng(seed)
    values = np.concatenate([random.normal(0, 1, 3000), random.lognormal(1, 1, 500), [250.0, 250.0, -90.0]])
    weight = random.integers(1, 1000, len(values))
    at = np.linspace(-100, 260, 400)
    direct = np.exp(-((at[:, None] - values) ** 2)) @ weight
    u = values - values.min()
    boxes, sums = distribution.box_moments(u, np.floor(u / distribution.BOX), weight)
    fast = distribution.hermite_sums(at - values.min(), boxes, sums)
    assert np.abs(fast - direct).max() <= 1e-12 * weight.sum()


def test_density_of_far_values_equals_the_direct_sum(spark):
    random = np.random.default_rng(4)
    values = np.concatenate([random.normal(1e6, 5, 2000), [1e6 + 4000.0]])
    df = stage(spark.createDataFrame([(float(v),) for v in values], "x DOUBLE").repartition(7), "far")
    rows = distribution.density_curve(df, "x").orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in rows:
        direct = np.exp(-0.5 * ((r["x"] - values) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(direct, abs=1e-9)


def test_histogram_runs(spark, skewed):
    df, _ = skewed
    runs = distribution.histogram_runs(df, "x").orderBy("bin").collect()
    every = distribution.histogram(df, "x").orderBy("bin").collect()
    opened = [(b, r["count"], r["density"]) for r in runs for b in range(r["bin"], r["bin"] + r["bins"])]
    assert opened == [(r["bin"], r["count"], r["density"]) for r in every]
    assert all(a["bin_high"] == b["bin_low"] for a, b in zip(runs, runs[1:]))
    far = stage(spark.createDataFrame([(float(i % 50),) for i in range(1000)] + [(1e15,)], "x DOUBLE"), "far")
    found = distribution.histogram_runs(far, "x").collect()
    assert len(found) < 120 and sum(r["count"] for r in found) == 1001 and max(r["bins"] for r in found) > 10**13
    assert distribution.histogram_runs(far.limit(0), "x").isEmpty()
    same = distribution.histogram_runs(far.filter("x = 7"), "x").collect()
    assert [(r["bin"], r["bins"], r["count"]) for r in same] == [(0, 1, 20)]


def test_quantiles_of_many_values_and_ties(spark):
    random = np.random.default_rng(6)
    values = np.concatenate([random.lognormal(0, 3, 5000), np.full(9000, 1.5), [math.inf, -math.inf, 0.0, -0.0]])
    df = stage(spark.createDataFrame([("g", float(v)) for v in values] + [("h", 1.0)], "g STRING, x DOUBLE").repartition(5), "ties")
    for most in (2, 70, 100_000):
        got = {r["g"]: list(r["quantiles"]) for r in quantiles(df, ["g"], "x", [0.1, 0.33, 0.5, 0.99], most_values=most).collect()}
        assert got == {"g": pytest.approx(list(np.quantile(values, [0.1, 0.33, 0.5, 0.99])), rel=1e-12), "h": [1.0] * 4}
