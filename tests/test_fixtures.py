import pytest
from pyspark.sql import functions as F

from tsubo.operators.cleaning import DUPLICATE_KEY
from tsubo.plans import fixtures, prepared, registry

LINE = "l_orderkey LONG, l_linenumber INT, l_partkey LONG, l_suppkey LONG, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE"


def lineitem(spark, folder, n=3000):
    rows = [(i, 1 + i % 7, i % 50 if i % 11 else None, i % 13, float(i % 5), 100.0, 0.1 * (i % 2), 0.0) for i in range(n)] + [(None,) * 8] * 5
    spark.createDataFrame(rows, LINE).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_copies_of_a_listing_meet_in_bounded_tasks(spark, tmp_path, monkeypatch):
    folder = lineitem(spark, tmp_path)
    table = spark.read.parquet(f"{folder}/lineitem.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "lineitem.parquet").glob("*.parquet"))
    monkeypatch.setattr(fixtures, "BYTES_PER_TASK", size // 40)
    together, apart = fixtures.raw_listings(table, copies_together=True), fixtures.raw_listings(table)
    assert together.rdd.getNumPartitions() >= 40
    placed = together.select(*DUPLICATE_KEY, F.spark_partition_id().alias("at")).groupBy(*DUPLICATE_KEY).agg(F.countDistinct("at").alias("tasks"))
    assert placed.agg(F.max("tasks")).first()[0] == 1
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()


def test_distinct_listings_move_no_wide_row(spark, tmp_path):
    """The queries that begin with the distinct listings shuffle line items, once, and no listing text."""
    folder = lineitem(spark, tmp_path)
    plan = registry.QUERIES["dedup_listings"](spark, folder)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange RoundRobin" in line]
    assert len(exchanges) == 1
    assert registry.QUERIES["dedup_listings"](spark, folder).count() == fixtures.raw_listings(spark.read.parquet(f"{folder}/lineitem.parquet")).select(*DUPLICATE_KEY).distinct().count()
    prepared.forget(spark)


@pytest.mark.parametrize("name", ["featured_view", "clean_listings", "plan_features", "box_by_station_ranked", "stored_view"])
def test_queries_of_distinct_listings_share_the_dealing(spark, tmp_path, monkeypatch, name):
    dealt, real = [], fixtures._copies_together
    monkeypatch.setattr(fixtures, "_copies_together", lambda *args: dealt.append(1) or real(*args))
    prepared.forget(spark)
    assert registry.QUERIES[name](spark, lineitem(spark, tmp_path, 300)).count() > 0
    assert dealt
    prepared.forget(spark)
