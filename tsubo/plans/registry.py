"""Named queries over the given tables, one per operator or report."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsubo.functions import labels, numbers
from tsubo.operators import cleaning, distribution, encode, features, pages, profile, regression, summary
from tsubo.plans import fixtures, listings, prepared
from tsubo.sources import tables, views
from tsubo.sources.staging import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE_URL = fixtures.BASE_URL
BOXES = {
    "box_by_floor_plan": "floor_plan",
    "box_by_distance": "distance_to_nearest_station",
    "box_by_station": "nearest_station",
    "box_by_building_size": "building_size",
    "box_by_floor": "floor",
}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _unused(name: str) -> str:
    """A name that no table or view of the user's has."""
    return f"{name}_{uuid.uuid4().hex}"


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "lineitem")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_pages(spark, f"{folder.rstrip('/')}/pages.parquet")


# Cleaning -------------------------------------------------------------------


@query
def dedup_listings(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.dedup_listings(prepared.raw(spark, folder, copies_together=True))


def _labels(spark: SparkSession, folder: str, **columns: Column) -> DataFrame:
    return prepared.raw(spark, folder).select("url", *(c.alias(name) for name, c in columns.items()))


@query
def standardize_money(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(
        spark,
        folder,
        rent=numbers.man_yen(F.col("rent")),
        management_fee=numbers.yen(F.col("management_fee")),
        deposit=numbers.man_yen(F.col("deposit")),
        key_money=numbers.man_yen(F.col("key_money")),
    )


@query
def standardize_area(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder, area=numbers.square_metres(F.col("area")))


@query
def standardize_floor_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder, floor_plan=labels.floor_plan(F.col("floor_plan")), floor=labels.floor_label(F.col("floor")))


@query
def building_age(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder, building_age=labels.building_age(F.col("building_age")))


@query
def building_size_label(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder, building_size=labels.building_size_label(F.col("building_size")))


@query
def building_size_total(spark: SparkSession, folder: str) -> DataFrame:
    label = labels.building_size_label(F.col("building_size"))
    return _labels(spark, folder, building_size=labels.building_size_total(label))


@query
def nullify_zero_fees(spark: SparkSession, folder: str) -> DataFrame:
    standard = cleaning.standardize(prepared.raw(spark, folder))
    return cleaning.nullify_zero_fees(standard).select("url", *cleaning.FEE_COLUMNS)


@query
def lenient_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw labels with their units still on: only the numeric prefix counts."""
    return _labels(
        spark,
        folder,
        rent_prefix=numbers.lenient_double(F.col("rent")),
        floor_prefix=numbers.lenient_bigint(F.col("floor")),
        area_prefix=numbers.lenient_bigint(F.col("area")),
        plan_prefix=numbers.lenient_bigint(F.col("floor_plan")),
    )


# Features and the view ------------------------------------------------------


@query
def station_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.station_features(prepared.standard(spark, folder))
    return rows.select("url", "nearest_station", "avg_rent_by_station", "count_listings_per_station")


@query
def plan_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.plan_features(prepared.standard(spark, folder))
    return rows.select("url", "floor_plan", "avg_rent_by_floor_plan", "count_listings_per_floor_plan")


@query
def station_features_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a summary held too large to broadcast: every key is split."""
    rows = features.station_features(prepared.standard(spark, folder), broadcast_bytes=0, slices=4)
    return rows.select("url", "nearest_station", "avg_rent_by_station", "count_listings_per_station")


@query
def featured_view(spark: SparkSession, folder: str) -> DataFrame:
    return listings.featured_view(prepared.raw(spark, folder, copies_together=True))


@query
def view_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The view as a named temporary view, read back with SQL."""
    name = _unused("listings_featured")
    tables.create_view(features.featured(prepared.standard(spark, folder)), name)
    return spark.sql(f"SELECT * FROM {name}")


@query
def stored_view(spark: SparkSession, folder: str) -> DataFrame:
    """The view stored over a table of half the listings; the other half is added before it is read."""
    table, view, path = _unused("listings_raw"), _unused("listings_featured"), new_path(spark, "listings-raw")
    raw = prepared.raw(spark, folder, copies_together=True)
    late = F.pmod(F.xxhash64("url"), F.lit(2)) == 1
    tables.write_table(raw.filter(~late), table, path)
    views.create_featured_view(spark, table, view)
    views.append_rows(raw.filter(late), table)
    return spark.table(view)


@query
def clean_listings(spark: SparkSession, folder: str) -> DataFrame:
    return listings.clean_listings(listings.featured_view(prepared.raw(spark, folder, copies_together=True)))


@query
def explode_floors(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.explode_floors(prepared.standard(spark, folder).select("url", "floor"))


@query
def floor_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.floor_rejects(prepared.standard(spark, folder))


@query
def floor_zero_to_one(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepared.clean(spark, folder).select("url", "floor", F.col("floor").alias("model_floor"))
    return rows.withColumn("model_floor", labels.ground_floor_to_first(F.col("model_floor")))


# Profiles and statistics ----------------------------------------------------


@query
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(prepared.clean(spark, folder))


SUMMARY_DIGITS = {c: 4 for c in ("mean", "std", "min", "max", "q25", "q50", "q75")}


@query
def describe_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.describe_numeric(prepared.clean(spark, folder)), **SUMMARY_DIGITS)


@query
def describe_numeric_by_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every group held too large for the in-memory quantiles."""
    return _rounded(profile.describe_numeric(prepared.clean(spark, folder), most_values=1000), **SUMMARY_DIGITS)


@query
def describe_text(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_text(prepared.clean(spark, folder))


INTERVAL_DIGITS = {c: 4 for c in ("mean", "margin", "lower", "upper")}


@query
def rent_confidence_interval(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary.confidence_interval(prepared.clean(spark, folder), "rent"), **INTERVAL_DIGITS)


@query
def rent_confidence_interval_by_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary.confidence_interval(prepared.clean(spark, folder), "rent", ["floor_plan"]), **INTERVAL_DIGITS)


@query
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary.correlation_matrix(prepared.clean(spark, folder)), r=6)


@query
def pearson_area_rent(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary.pearson_test(prepared.clean(spark, folder), "area", "rent"), r=8, t=4, p=8)


@query
def pearson_age_rent(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(summary.pearson_test(prepared.clean(spark, folder), "building_age", "rent"), r=8, t=4, p=8)


@query
def pearson_distance_rent(spark: SparkSession, folder: str) -> DataFrame:
    """A weak correlation, whose p is far from 0."""
    return _rounded(summary.pearson_test(prepared.clean(spark, folder), "distance_to_nearest_station", "rent"), r=8, t=4, p=8)


# Chart data -----------------------------------------------------------------

HISTOGRAM_DIGITS = {"bin_low": 4, "bin_high": 4, "density": 12}
CURVE_DIGITS = {"x": 4, "density": 12}


@query
def rent_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(distribution.histogram(prepared.clean(spark, folder), "rent"), **HISTOGRAM_DIGITS)


@query
def rate_histogram_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A skewed value: far bins are empty, and each run of them is one row."""
    rows = prepared.clean(spark, folder).select((F.col("rent") * F.col("rent") / F.col("area")).alias("rate"))
    return _rounded(distribution.histogram_runs(rows, "rate"), **HISTOGRAM_DIGITS)


@query
def rent_kde(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(distribution.density_curve(prepared.clean(spark, folder), "rent"), **CURVE_DIGITS)


def _box(name: str, group: str) -> None:
    def box(spark: SparkSession, folder: str) -> DataFrame:
        return distribution.box_summary(prepared.clean(spark, folder), group, "rent")

    def outliers(spark: SparkSession, folder: str) -> DataFrame:
        return distribution.box_outliers(prepared.clean(spark, folder), group, "rent")

    QUERIES[name] = box
    QUERIES[name.replace("box", "box_outliers")] = outliers


for _name, _group in BOXES.items():
    _box(_name, _group)


def _box_of_rate(name: str, group: str) -> None:
    def outliers(spark: SparkSession, folder: str) -> DataFrame:
        """Rent per square metre, which is skewed: every grouping has outliers."""
        rows = prepared.clean(spark, folder).withColumn("rate", F.col("rent") / F.col("area"))
        return distribution.box_outliers(rows, group, "rate")

    QUERIES[name.replace("box", "box_outliers_of_rate")] = outliers


for _name, _group in BOXES.items():
    _box_of_rate(_name, _group)


@query
def box_by_station_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The station box plot with the large-group quantiles and the sliced join."""
    rows = prepared.clean(spark, folder)
    return distribution.box_summary(rows, "nearest_station", "rent", broadcast_bytes=0, most_values=500)


@query
def scatter_area_rent(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.scatter(prepared.clean(spark, folder), "area", "rent")


@query
def scatter_age_rent(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.scatter(prepared.clean(spark, folder), "building_age", "rent")


# Modelling ------------------------------------------------------------------


@query
def train_test_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prepared.split(spark, folder).groupBy("is_test", "fold").agg(F.count(F.lit(1)).alias("n"))


@query
def train_test_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return prepared.split(spark, folder).select("url", "floor", "rent", "is_test", "fold")


@query
def one_hot_floor_plan(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepared.split(spark, folder)
    values = encode.categories(rows.filter(~F.col("is_test")), "floor_plan")
    hot = encode.one_hot(rows, "floor_plan", values)
    return hot.select("url", *regression.NUMERIC, *encode.feature_names("floor_plan", values))


@query
def one_hot_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The dummies of a feature with nearly as many categories as rows, as one row per entry that is not zero."""
    rows = prepared.split(spark, folder).select("url", "floor", "is_test")
    slots = encode.category_slots(rows.filter(~F.col("is_test")), "url")
    return encode.one_hot_entries(rows, "url", slots)


@query
def assembled_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature vector of every row, opened again by place."""
    rows = prepared.split(spark, folder)
    values = encode.categories(rows.filter(~F.col("is_test")), "floor_plan")
    names = [*regression.NUMERIC, *encode.feature_names("floor_plan", values)]
    hot = encode.one_hot(rows.withColumn("at_floor", F.col("floor")), "floor_plan", values)
    opened = encode.assemble(hot, names).select("url", "at_floor", vector_to_array("features").alias("v"))
    return opened.select("url", "at_floor", F.size("v").alias("n_features"), *(F.col("v")[i].alias(f"x{i}") for i in range(len(names))))


def _standardized(spark: SparkSession, folder: str, refit: bool) -> DataFrame:
    rows = prepared.split(spark, folder)
    values = encode.categories(rows.filter(~F.col("is_test")), "floor_plan")
    names = [*regression.NUMERIC, *encode.feature_names("floor_plan", values)]
    # The floor names the row as well, so it is kept as it was.
    hot = encode.one_hot(rows, "floor_plan", values).withColumn("at_floor", F.col("floor"))
    scaled = encode.standardize_features(hot, names, refit_on_test=refit)
    return _rounded(scaled.select("url", "at_floor", "is_test", *names), **dict.fromkeys(names, 6))


@query
def standardize_features(spark: SparkSession, folder: str) -> DataFrame:
    return _standardized(spark, folder, refit=False)


@query
def standardize_features_refit(spark: SparkSession, folder: str) -> DataFrame:
    return _standardized(spark, folder, refit=True)


@query
def simple_regression(spark: SparkSession, folder: str) -> DataFrame:
    train = prepared.split(spark, folder).filter(~F.col("is_test"))
    return _rounded(regression.simple_regression(train, "area", "rent"), slope=6, intercept=4, r2=8)


@query
def cv_simple_r2(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression.cross_validate_simple(regression.moments(prepared.split(spark, folder)), "area"), r2=8)


@query
def cv_multiple_r2(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression.cross_validate(regression.moments(prepared.split(spark, folder))), r2=8)


@query
def cv_mean_r2(spark: SparkSession, folder: str) -> DataFrame:
    m = regression.moments(prepared.split(spark, folder))
    simple = regression.cross_validate_simple(m, "area").agg(F.lit("simple").alias("model"), F.avg("r2").alias("mean_r2"))
    multiple = regression.cross_validate(m).agg(F.lit("multiple").alias("model"), F.avg("r2").alias("mean_r2"))
    return _rounded(simple.unionByName(multiple), mean_r2=8)


@query
def multiple_regression_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression.scores(prepared.model(spark, folder)), r2=8)


@query
def coef_table(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(regression.coefficients(prepared.model(spark, folder)), coefficient=4, feature_std=8, per_unit=4)


def _residuals(spark: SparkSession, folder: str, refit: bool) -> DataFrame:
    test = prepared.split(spark, folder).filter("is_test")
    return regression.residuals(prepared.model(spark, folder), test, refit_on_test=refit)


@query
def residuals(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_residuals(spark, folder, refit=False), predicted=2, residual=2)


@query
def residuals_refit(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_residuals(spark, folder, refit=True), predicted=2, residual=2)


@query
def residual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    errors = stage(_residuals(spark, folder, refit=True).select("residual"), "residuals")
    return _rounded(distribution.histogram(errors, "residual"), **HISTOGRAM_DIGITS)


@query
def residual_kde(spark: SparkSession, folder: str) -> DataFrame:
    errors = stage(_residuals(spark, folder, refit=True).select("residual"), "residuals")
    return _rounded(distribution.density_curve(errors, "residual", cut=0.0), **CURVE_DIGITS)


# Pages ----------------------------------------------------------------------


@query
def html_roundtrip_listings(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_listings(fixtures.listing_pages(_lineitem(spark, folder)), BASE_URL, deal=False)


@query
def html_strict_stations(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extract_listings(fixtures.listing_pages(_lineitem(spark, folder)), BASE_URL, deal=False, strict_stations=True)
    return found.select("url", "nearest_station", "distance_to_nearest_station", "avg_distance_to_stations")


@query
def html_images(spark: SparkSession, folder: str) -> DataFrame:
    """The picture of every listing's building."""
    found = pages.extract_listings(fixtures.pictured_pages(_lineitem(spark, folder)), BASE_URL, deal=False, with_image=True)
    return found.select("url", "img")


@query
def html_block_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return pages.block_rejects(pages.building_blocks(fixtures.listing_pages(_lineitem(spark, folder)), deal=False))


@query
def html_next_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.next_pages(fixtures.crawled_pages(_pages(spark, folder)), BASE_URL)


@query
def html_page_frontier(spark: SparkSession, folder: str) -> DataFrame:
    return pages.frontier(pages.next_pages(fixtures.crawled_pages(_pages(spark, folder)), BASE_URL))


@query
def append_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The crawl with all its pages fetched a second time: a bag, with its duplicates."""
    crawl = fixtures.crawled_pages(_pages(spark, folder))
    return pages.duplicate_pages(tables.append_pages(crawl, crawl))


@query
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_links(_pages(spark, folder), BASE_URL)


# Sources and sinks ----------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "listings-csv")
    tables.write_csv(prepared.clean(spark, folder), path, byte_order_mark=True)
    return tables.read_csv(spark, path, tables.LISTINGS_CLEAN_SCHEMA, multi_line=True)


@query
def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """An external table of its own name, dropped again; its files stay until the session ends."""
    name, path = _unused("listings_raw"), new_path(spark, "listings-raw")
    schema = tables.write_table(prepared.raw(spark, folder), name, path).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)
