import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tsubo.functions.keys import shuffle_order
from tsubo.operators import encode, regression, split
from tsubo.sources.staging import stage

FEATURES = regression.NUMERIC


@pytest.fixture(scope="module")
def modelled(spark):
    random = np.random.default_rng(11)
    plans = random.choice(["1K", "1R", "2DK", "1DK", "9X"], 700, p=[0.34, 0.3, 0.2, 0.158, 0.002])
    data = []
    for i, plan in enumerate(plans):
        area, age, size, floor = random.uniform(10, 60), random.integers(0, 40), random.integers(1, 12), random.integers(-1, 10)
        rent = 3000 * area - 500 * age + 100 * size + 50 * floor + {"1K": 0, "1R": 4e3, "2DK": -2e3}.get(plan, 1e3) + random.normal(0, 8000)
        data.append((f"u{i}", float(rent), float(area), int(age), int(size), int(floor), str(plan)))
    df = spark.createDataFrame(data, "url STRING, rent DOUBLE, area DOUBLE, building_age BIGINT, building_size BIGINT, floor BIGINT, floor_plan STRING")
    return stage(split.train_test_split(stage(df, "rows"), "url", "floor"), "split")


def arrays(rows, categories):
    x = np.array([[r[f] for f in FEATURES] + [float(r["floor_plan"] == c) for c in categories[1:]] for r in rows], float)
    return x, np.array([r["rent"] for r in rows])


def least_squares(x, y):
    """Intercept and coefficients of centred least squares."""
    coefficients = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)[0]
    return y.mean() - x.mean(axis=0) @ coefficients, coefficients


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def scaled(x, by):
    deviation = by.std(axis=0)
    return (x - by.mean(axis=0)) / np.where(deviation > 0, deviation, 1)


def test_split_sizes_and_folds(modelled):
    found = {(r["is_test"], r["fold"]): r["n"] for r in modelled.groupBy("is_test", "fold").agg(F.count("url").alias("n")).collect()}
    assert found == {(True, None): 140, **{(False, i): 112 for i in range(5)}}


@pytest.mark.parametrize("rows", [1, 3, 7, 101])
def test_split_sizes_of_small_tables(spark, rows):
    df = spark.range(rows).withColumn("id", F.col("id"))
    got = split.train_test_split(df, "id").collect()
    tests = math.ceil(0.2 * rows)
    assert sum(r["is_test"] for r in got) == tests
    assert sorted(sum(r["fold"] == i for r in got) for i in range(5)) == sorted((rows - tests) // 5 + (i < (rows - tests) % 5) for i in range(5))


@pytest.mark.parametrize("copies", [False, True])
def test_split_sizes_with_tied_keys(spark, copies):
    """Half of the rows have no key; they differ in another column, or are exact copies."""
    rows = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("url"),
        F.when((F.col("id") % 2 == 0) | F.lit(not copies), F.col("id")).alias("other"),
    )
    got = split.train_test_split(stage(rows, "tied_rows"), "url")
    assert sorted(got.select("url", "other").collect(), key=str) == sorted(rows.collect(), key=str)
    found = {(r["is_test"], r["fold"]): r["n"] for r in got.groupBy("is_test", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {(True, None): 200, **{(False, i): 160 for i in range(5)}}


def test_split_does_not_depend_on_partitioning(modelled):
    columns = [c for c in modelled.columns if c not in ("is_test", "fold")]
    again = split.train_test_split(modelled.select(columns).repartition(7), "url", "floor")
    assert sorted(modelled.collect()) == sorted(again.select(modelled.columns).collect())


def test_values_at_ranks_follow_prefixes(spark, monkeypatch):
    monkeypatch.setattr(split, "ROWS_ON_DRIVER", 0)
    df = spark.range(5000).select(shuffle_order(F.col("id")).alias("o")).union(spark.range(700).select(F.lit(12345).cast("bigint").alias("o")))
    ordered = sorted(r[0] for r in df.collect())
    ranks = [0, 699, 700, 2500, len(ordered) - 1]
    assert split.values_at_ranks(df, "o", ranks) == [ordered[r] for r in ranks]


def test_fit_equals_numpy(modelled):
    rows = modelled.collect()
    train, test = [r for r in rows if not r["is_test"]], [r for r in rows if r["is_test"]]
    categories = sorted({r["floor_plan"] for r in train})
    x, y = arrays(train, categories)
    xt, yt = arrays(test, categories)
    fit = regression.fit(regression.moments(modelled))

    intercept, coefficients = least_squares(scaled(x, x), y)
    table = {r["feature"]: r for r in regression.coefficients(fit).collect()}
    names = FEATURES + [f"floor_plan_{c}" for c in categories[1:]]
    assert set(table) == set(names)
    assert [table[n]["coefficient"] for n in names] == pytest.approx(coefficients.tolist(), rel=1e-7)
    assert [table[n]["feature_std"] for n in names] == pytest.approx(x.std(axis=0, ddof=1).tolist(), rel=1e-9)
    assert table["area"]["per_unit"] == pytest.approx(coefficients[0] / x[:, 0].std(ddof=1))
    assert table[names[-1]]["per_unit"] is None

    own, again = intercept + scaled(xt, x) @ coefficients, intercept + scaled(xt, xt) @ coefficients
    scores = {r["subset"]: (r["n"], r["r2"]) for r in regression.scores(fit).collect()}
    assert scores["train"] == (len(y), pytest.approx(r2(y, intercept + scaled(x, x) @ coefficients)))
    assert scores["test"] == (len(yt), pytest.approx(r2(yt, own)))
    assert scores["test_refitted"] == (len(yt), pytest.approx(r2(yt, again)))

    test_rows = modelled.filter("is_test")
    for refit, expected in ((False, own), (True, again)):
        got = sorted(tuple(r) for r in regression.residuals(fit, test_rows, refit_on_test=refit).collect())
        want = sorted(zip(yt, expected, expected - yt, strict=True))
        assert np.array(got) == pytest.approx(np.array(want), rel=1e-7)


def test_fit_equals_spark_ml(modelled):
    train = modelled.filter("NOT is_test")
    values = encode.categories(train, "floor_plan")
    names = [*FEATURES, *encode.feature_names("floor_plan", values)]
    model = LinearRegression(featuresCol="features", labelCol="rent", solver="normal").fit(encode.assemble(encode.one_hot(train, "floor_plan", values), names))
    fit = regression.fit(regression.moments(modelled))
    assert list(model.coefficients[:4]) == pytest.approx([fit.slopes[f] for f in FEATURES], rel=1e-6)


def test_cross_validation_equals_numpy(modelled):
    train = [r for r in modelled.collect() if not r["is_test"]]
    categories = sorted({r["floor_plan"] for r in train})
    moments = regression.moments(modelled)
    many = {r["fold"]: r["r2"] for r in regression.cross_validate(moments).collect()}
    one = {r["fold"]: r["r2"] for r in regression.cross_validate_simple(moments, "area").collect()}
    for fold in range(5):
        x, y = arrays([r for r in train if r["fold"] != fold], categories)
        xh, yh = arrays([r for r in train if r["fold"] == fold], categories)
        a, b = least_squares(x, y)
        assert many[fold] == pytest.approx(r2(yh, a + xh @ b), rel=1e-7)
        a, b = least_squares(x[:, :1], y)
        assert one[fold] == pytest.approx(r2(yh, a + xh[:, :1] @ b), rel=1e-9)


def test_unknown_category_counts_as_baseline(spark, modelled):
    fit = regression.fit(regression.moments(modelled))
    row = (30.0, 10, 3, 2)
    new = stage(spark.createDataFrame([(*row, "7LDK"), (*row, fit.baseline), (*row, None)], "area DOUBLE, building_age BIGINT, building_size BIGINT, floor BIGINT, floor_plan STRING"), "new")
    assert len({round(r["predicted"], 6) for r in regression.predict(fit, new).collect()}) == 1


def test_one_hot_drops_the_first_category(spark):
    train = spark.createDataFrame([("1K",), ("1R",), ("1DK",), ("1K",)], "p STRING")
    values = encode.categories(train, "p")
    assert encode.feature_names("p", values) == ["p_1K", "p_1R"]
    got = encode.one_hot(spark.createDataFrame([("1DK",), ("1K",), ("new",), (None,)], "p STRING"), "p", values).collect()
    assert {r["p"]: tuple(r)[1:] for r in got} == {"1DK": (0.0, 0.0), "1K": (1.0, 0.0), "new": (0.0, 0.0), None: (0.0, 0.0)}


def test_scaling_keeps_constant_features(spark):
    df = spark.createDataFrame([(1.0, 5.0, False), (3.0, 5.0, False), (9.0, 6.0, True), (11.0, 6.0, True)], "a DOUBLE, b DOUBLE, is_test BOOLEAN")
    own = sorted(tuple(r) for r in encode.standardize_features(df, ["a", "b"]).collect())
    assert own == [(-1.0, 0.0, False), (1.0, 0.0, False), (7.0, 1.0, True), (9.0, 1.0, True)]
    refit = sorted(tuple(r) for r in encode.standardize_features(df, ["a", "b"], refit_on_test=True).collect())
    assert refit == [(-1.0, 0.0, False), (-1.0, 0.0, True), (1.0, 0.0, False), (1.0, 0.0, True)]


def test_one_hot_vector_equals_the_columns(spark):
    train = spark.createDataFrame([("1K",), ("1R",), ("1DK",), ("1K",), (None,)], "p STRING")
    rows = spark.createDataFrame([("1DK",), ("1K",), ("1R",), ("new",), (None,)], "p STRING")
    got = {r["p"]: r["v"].toArray().tolist() for r in encode.one_hot_vector(rows, "p", encode.category_slots(train, "p"), "v").collect()}
    assert got == {"1DK": [0, 0], "1K": [1, 0], "1R": [0, 1], "new": [0, 0], None: [0, 0]}


def test_one_hot_of_a_hundred_thousand_categories(spark):
    train = stage(spark.range(100_000).select(F.format_string("c%06d", F.col("id")).alias("c"), F.col("id").alias("k")), "wide")
    slots = encode.category_slots(train, "c")
    rows = train.unionByName(spark.createDataFrame([("new", -1), (None, -2)], "c STRING, k BIGINT"))
    entries = encode.one_hot_entries(rows, "c", slots)
    assert entries.columns == ["c", "k", "slot", "value"] and entries.count() == 99_999
    assert entries.filter((F.col("slot") != F.col("k")) | (F.col("value") != 1.0)).isEmpty()
    vector = encode.one_hot_vector(rows.filter("k IN (-2, -1, 0, 1, 99999)"), "c", slots, "v")
    got = {r["k"]: (r["v"].size, r["v"].indices.tolist()) for r in vector.collect()}
    assert got == {-2: (99_999, []), -1: (99_999, []), 0: (99_999, []), 1: (99_999, [0]), 99999: (99_999, [99_998])}
    one = encode.category_slots(train.filter("k = 0"), "c")
    assert encode.one_hot_entries(rows, "c", one).isEmpty()
    assert {tuple(r["v"].toArray()) for r in encode.one_hot_vector(rows.filter("k < 2"), "c", one, "v").collect()} == {(0.0,)}


def exact_slopes(rows, features):
    """Slopes about category means in rational arithmetic."""
    by = {}
    for r in rows:
        by.setdefault(r["floor_plan"], []).append([Fraction(r[v]) for v in (*features, "rent")])
    centred = []
    for part in by.values():
        means = [sum(c) / len(part) for c in zip(*part)]
        centred += [[v - m for v, m in zip(row, means)] for row in part]
    k = len(features)
    system = [[sum(r[i] * r[j] for r in centred) for j in range(k + 1)] for i in range(k)]
    for i in range(k):
        pivot = system[i][i]
        system[i] = [v / pivot for v in system[i]]
        for j in range(k):
            if j != i:
                system[j] = [a - system[j][i] * b for a, b in zip(system[j], system[i])]
    return [float(system[i][k]) for i in range(k)]


def test_nearly_collinear_features_agree_with_rational_arithmetic(spark):
    random = np.random.default_rng(12)
    data = []
    for i in range(400):
        area = random.uniform(10, 60)
        age = area + 1e-8 * random.normal()  # differs from the area in the eighth decimal
        size, floor = random.uniform(1, 12), random.uniform(0, 9)
        data.append((f"u{i}", 3000 * area + 1e9 * (age - area) + 10 * size + random.normal(), area, age, size, floor, f"p{i % 7}"))
    df = spark.createDataFrame(data, "url STRING, rent DOUBLE, area DOUBLE, building_age DOUBLE, building_size DOUBLE, floor DOUBLE, floor_plan STRING")
    rows = stage(split.train_test_split(stage(df.repartition(5), "rows"), "url"), "split")
    m = regression.moments(rows)
    train = rows.filter(~F.col("is_test")).collect()
    want = exact_slopes(train, FEATURES)
    found = regression.fit(m).slopes
    assert [found[v] for v in FEATURES] == pytest.approx(want, rel=1e-5, abs=1e-2)
    x = np.array([[r[f] for f in FEATURES] for r in train])
    by_plan = np.array([r["floor_plan"] for r in train])
    centred = x - np.array([x[by_plan == p].mean(axis=0) for p in by_plan])
    product = centred.T @ centred
    assert np.linalg.cond(product) > 1e15  # what the cross products would have had to be solved from
    for fold, factor in regression.within_factors(m, [0, 1, 2, 3, 4]).items():
        kept = [r for r in train if r["fold"] != fold]
        got = regression._solve(factor, m)
        assert [got[v] for v in FEATURES] == pytest.approx(exact_slopes(kept, FEATURES), rel=1e-5, abs=1e-2), fold


def test_exact_collinearity_and_many_categories(spark, monkeypatch):
    monkeypatch.setattr(regression, "FACTORS_HELD", 10)
    data = [(f"u{i}", 5.0 * (i % 50) + (i // 50), float(i % 50), i % 50, 3, i % 50 * 2, f"p{i // 50}") for i in range(3000)]
    df = spark.createDataFrame(data, "url STRING, rent DOUBLE, area DOUBLE, building_age BIGINT, building_size BIGINT, floor BIGINT, floor_plan STRING")
    rows = stage(split.train_test_split(stage(df.repartition(5), "rows"), "url"), "split")
    f = regression.fit(regression.moments(rows))
    assert f.slopes["building_size"] == 0.0
    assert f.slopes["area"] + f.slopes["building_age"] + 2 * f.slopes["floor"] == pytest.approx(5.0)
    assert [r["r2"] for r in regression.scores(f).collect()][:2] == pytest.approx([1.0, 1.0])
