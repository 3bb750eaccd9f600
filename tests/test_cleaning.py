from pyspark.sql import Window
from pyspark.sql import functions as F

from tsubo.operators import cleaning, features
from tsubo.operators.lookup import attach, hot_hashes
from tsubo.operators.ranking import numbered
from tsubo.plans import fixtures, listings
from tsubo.sources.staging import measure, stage
from tsubo.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def raw(spark):
    return fixtures.raw_listings(read_table(spark, SMALL, "lineitem"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_dedup_is_idempotent_and_independent_of_partitioning(spark):
    once = cleaning.dedup_listings(raw(spark))
    assert rows(once) == rows(cleaning.dedup_listings(once))
    assert rows(once) == rows(cleaning.dedup_listings(raw(spark).repartition(13, "url")))


def test_dedup_breaks_url_ties_by_the_other_columns(spark):
    columns = fixtures.RAW_COLUMNS
    same = dict.fromkeys(columns, None) | {"title": "t", "url": "u"}
    data = [tuple((same | {"address": a})[c] for c in columns) for a in ("b", "a", "c")]
    kept = cleaning.dedup_listings(spark.createDataFrame(data, ", ".join(f"{c} STRING" for c in columns)).repartition(3))
    assert [r["address"] for r in kept.collect()] == ["a"]


def test_dedup_limits_a_hot_key_before_the_shuffle(spark):
    plan = cleaning.dedup_listings(raw(spark))._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Exchange hashpartitioning"), plan.rindex("WindowGroupLimit")
    assert before < after, "the partial group limit runs below the exchange"


def test_wide_floor_ranges_are_opened_whole(spark):
    listing = spark.createDataFrame([("a", "1-5000"), ("b", "B2-1"), ("c", "7-3"), ("d", "-")], "url STRING, floor STRING")
    got = cleaning.explode_floors(listing, step=7).groupBy("url").agg(F.count("floor"), F.min("floor"), F.max("floor"))
    assert {tuple(r) for r in got.collect()} == {("a", 5000, 1, 5000), ("b", 4, -2, 1)}


def test_floor_rejects_count_every_row(spark):
    listing = spark.createDataFrame([(f,) for f in ("3", "5-3", "-", "", "M2", "B2-B1", None, "1-2")], "floor STRING")
    found = {r["outcome"]: r["listings"] for r in cleaning.floor_rejects(listing).collect()}
    assert found == {"kept": 2, "descending": 1, "missing": 2, "unreadable": 3}


def test_features_equal_windows(spark):
    standard = stage(listings.standard_listings(raw(spark)), "standard")
    station, plan = Window.partitionBy("nearest_station"), Window.partitionBy("floor_plan")
    expected = cleaning.nullify_zero_fees(
        standard.withColumns(
            {
                "avg_rent_by_station": F.round(F.avg("rent").over(station), 2),
                "avg_rent_by_floor_plan": F.round(F.avg("rent").over(plan), 2),
                "count_listings_per_station": F.count("title").over(station),
                "count_listings_per_floor_plan": F.count("title").over(plan),
            }
        )
    ).select(features.FEATURED_COLUMNS)
    assert rows(features.featured(standard)) == rows(expected)
    assert rows(features.featured(standard, broadcast_bytes=0, slices=3)) == rows(expected)


def test_attach_hot_and_null_keys(spark):
    data = [(None, i) for i in range(50)] + [("hot", i) for i in range(500)] + [("x", 1), ("none", 1)]
    big = stage(spark.createDataFrame(data, "k STRING, v INT"), "big")
    small = spark.createDataFrame([(None, 1), ("hot", 2), ("x", 3)], "k STRING, s INT")
    whole, sliced = attach(big, small, ["k"]), attach(big, small, ["k"], broadcast_bytes=0, slices=5)
    assert rows(whole) == rows(sliced)
    assert {r["s"]: r["n"] for r in sliced.groupBy("s").agg(F.count("v").alias("n")).collect()} == {1: 50, 2: 500, 3: 1, None: 1}
    semi = attach(big, small, ["k"], how="left_semi", broadcast_bytes=0, slices=5)
    assert semi.columns == ["k", "v"] and semi.count() == 551
    assert "Broadcast" in whole._jdf.queryExecution().executedPlan().toString()


def test_attach_splits_hot_keys_alone(spark):
    data = [("hot" if i % 3 else f"k{i}", i) for i in range(6000)]
    big = stage(spark.createDataFrame(data, "k STRING, v INT"), "big")
    small = stage(big.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "small")
    assert len(hot_hashes(F.struct("k"), big)) < 500
    joined = attach(big, small, ["k"], "inner", broadcast_bytes=0, slices=16)
    assert joined.count() == 6000 and joined.agg(F.sum("n")).first()[0] == 4000 * 4000 + 2000
    plan = attach(big, small, ["k"], "inner", broadcast_bytes=0).select("k", "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "_slice" in plan


def test_numbered(spark):
    data = [(g, i % 700) for i in range(3000) for g in ["a" if i % 4 else (None if i % 8 else f"g{i}")]]
    rows_in = stage(spark.createDataFrame(data, "g STRING, v INT").repartition(5), "numbered")
    by_group = {}
    for r in numbered(rows_in, ["g"], [F.col("v")], partitions=7).collect():
        by_group.setdefault(r["g"], []).append((r["position"], r["v"]))
    for found in by_group.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found))) and [v for _, v in found] == sorted(v for _, v in found)
    every = numbered(rows_in, [], [F.col("g").asc_nulls_first(), F.col("v")], partitions=4).orderBy("position").collect()
    assert [r["position"] for r in every] == list(range(3000))
    assert [((r["g"] or ""), r["v"]) for r in every] == sorted(((g or ""), v) for g, v in data)
    nothing = numbered(stage(rows_in.limit(0), "none"), ["g"], [F.col("v")])
    assert nothing.columns == ["g", "v", "position"] and nothing.count() == 0


def test_measure_counts_text_bytes(spark):
    size = measure(spark.createDataFrame([("万円", 1), (None, 2)], "t STRING, n INT"))
    assert size.rows == 2 and size.bytes == 6 + 4 * 16
