"""From collected pages to the model, as the README shows it."""

from tsubo.operators import cleaning, pages, regression, split, summary
from tsubo.plans import fixtures, listings
from tsubo.sources import staging, tables


def test_from_pages_to_model(spark):
    lineitem = tables.read_table(spark, "/root/testdata/sf0.001", "lineitem")
    collected = staging.stage(fixtures.listing_pages(lineitem), "pages")
    raw = pages.extract_listings(collected, fixtures.BASE_URL)
    view = tables.create_view(listings.featured_view(raw), "listings_featured")
    assert len(view.columns) == 19
    clean = staging.stage(listings.clean_listings(view), "clean")
    assert clean.schema.simpleString() == spark.createDataFrame([], tables.LISTINGS_CLEAN_SCHEMA).schema.simpleString()
    # The same rows as from the listing table; only the stations read differently.
    expected = listings.clean_listings(listings.standard_listings(fixtures.raw_listings(lineitem)))
    assert clean.count() == expected.count()
    assert summary.confidence_interval(clean, "rent").first()["sample_size"] == clean.count()
    parts = split.train_test_split(regression.complete_rows(clean), "url", "floor")
    parts = staging.stage(cleaning.ground_floor_to_first(parts), "split")
    model = regression.fit(regression.moments(parts))
    assert regression.coefficients(model).count() == 11
    assert all(0.8 < r["r2"] < 1 for r in regression.scores(model).collect())


def test_split_by_listing_keeps_floors_together(spark):
    rows = staging.stage(spark.range(200).selectExpr("concat('u', id div 4) AS url", "id % 4 AS floor"), "listed")
    sides = split.train_test_split(rows, "url").groupBy("url").agg({"is_test": "max"}).count()
    assert sides == 50
    mixed = split.train_test_split(rows, "url").select("url", "is_test").distinct().count()
    assert mixed == 50
