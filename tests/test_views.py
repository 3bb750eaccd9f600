"""The stored view: it follows its table, costs no job to create, and reads labels as the column functions do."""

from pyspark.sql import functions as F

from tsubo.functions import labels, numbers
from tsubo.plans import fixtures, listings
from tsubo.sources import tables, views

ODD = [None, "", "-", "8.3万円", "1e3万円x", "５階", "3階階", "5000円", "新築", "築12年", "築99年以上", "築99999999999999999999年", "築-99999999999999999999年", "平屋", "地下1地上3階建", "ワンルーム", "25.5m2", " +7", "o'clock", "a\\b"]


def test_label_functions_equal_the_column_functions(spark):
    views.create_label_functions(spark)
    label = F.col("label")
    same = {
        "double": numbers.lenient_double(label), "bigint": numbers.lenient_bigint(label), "man_yen": numbers.man_yen(label),
        "yen": numbers.yen(label), "square_metres": numbers.square_metres(label), "floor": labels.floor_label(label),
        "floor_plan": labels.floor_plan(label), "building_age": labels.building_age(label), "building_size": labels.building_size_label(label),
    }
    assert set(same) == set(views._functions())
    rows = spark.createDataFrame([(t,) for t in ODD], "label STRING")
    found = rows.select("label", *(F.expr(f"{views.PREFIX}{name}(label)").alias(f"sql_{name}") for name in same), *(c.alias(name) for name, c in same.items()))
    for row in found.collect():
        for name in same:
            assert row[f"sql_{name}"] == row[name], (row["label"], name)
    views.drop_label_functions(spark)
    views.drop_label_functions(spark)
    assert not spark.sql(f"SHOW USER FUNCTIONS LIKE '{views.PREFIX}*'").collect()


def test_view_follows_its_table(spark, tmp_path):
    raw = fixtures.raw_listings(tables.read_table(spark, "/root/testdata/sf0.001", "lineitem"))
    late = F.pmod(F.xxhash64("url"), F.lit(3)) == 1
    spark.sql("DROP TABLE IF EXISTS listings_followed")
    tables.write_table(raw.filter(~late), "listings_followed", str(tmp_path / "followed"))
    try:
        context = spark.sparkContext
        context.setJobGroup("creating a view", "")
        views.create_featured_view(spark, "listings_followed", "featured_followed")
        views.create_featured_view(spark, "listings_followed", "featured_followed")  # once more changes nothing
        jobs = context.statusTracker().getJobIdsForGroup("creating a view")
        context.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) == 0
        assert [t.name for t in spark.catalog.listTables() if t.name == "featured_followed" and not t.isTemporary] == ["featured_followed"]

        def rows(df):
            return sorted(map(str, df.collect()))

        assert rows(spark.table("featured_followed")) == rows(listings.featured_view(raw.filter(~late)))
        views.append_rows(raw.filter(late), "listings_followed")
        assert rows(spark.table("featured_followed")) == rows(listings.featured_view(raw))
        assert rows(spark.newSession().table("featured_followed")) == rows(listings.featured_view(raw))
        narrow = spark.sql("SELECT rent FROM featured_followed")._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in narrow and "Python" not in narrow
    finally:
        spark.sql("DROP VIEW IF EXISTS featured_followed")
        spark.sql("DROP TABLE IF EXISTS listings_followed")
        views.drop_label_functions(spark)
