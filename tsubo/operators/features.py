"""Average rent and listing counts per station and per floor plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsubo.operators.cleaning import nullify_zero_fees
from tsubo.operators.lookup import attach
from tsubo.sources.staging import stage

FEATURED_COLUMNS = [
    "url", "title", "address", "rent", "management_fee", "deposit", "key_money", "floor", "floor_plan", "area",
    "building_age", "building_size", "nearest_station", "distance_to_nearest_station", "avg_distance_to_stations",
    "avg_rent_by_station", "avg_rent_by_floor_plan", "count_listings_per_station", "count_listings_per_floor_plan",
]


def group_rent(listings: DataFrame, by: list[str]) -> DataFrame:
    """Partial sums per group; these add up again over fewer columns."""
    return listings.groupBy(*by).agg(
        F.sum("rent").alias("rent_sum"), F.count("rent").alias("rent_count"), F.count("title").alias("titles")
    )


def _finish(parts: DataFrame, key: str, suffix: str) -> DataFrame:
    return parts.groupBy(key).agg(
        F.round(F.try_divide(F.sum("rent_sum"), F.sum("rent_count")), 2).alias(f"avg_rent_by_{suffix}"),
        F.sum("titles").alias(f"count_listings_per_{suffix}"),
    )


def station_features(standard: DataFrame, **limits) -> DataFrame:
    parts = stage(group_rent(standard, ["nearest_station"]), "rent-parts")
    return attach(standard, _finish(parts, "nearest_station", "station"), ["nearest_station"], **limits)


def plan_features(standard: DataFrame, **limits) -> DataFrame:
    parts = stage(group_rent(standard, ["floor_plan"]), "rent-parts")
    return attach(standard, _finish(parts, "floor_plan", "floor_plan"), ["floor_plan"], **limits)


def featured(standard: DataFrame, **limits) -> DataFrame:
    """The 19-column listing view from standardised, distinct listings.

    A window per group would move every full row twice and hold a hot station
    in one task; here the rows are read once more for four narrow columns, and
    only the sums move.  ``standard`` should be a written stage.
    """
    parts = stage(group_rent(standard, ["nearest_station", "floor_plan"]), "rent-parts")
    with_station = attach(standard, _finish(parts, "nearest_station", "station"), ["nearest_station"], **limits)
    with_both = attach(with_station, _finish(parts, "floor_plan", "floor_plan"), ["floor_plan"], **limits)
    return nullify_zero_fees(with_both).select(FEATURED_COLUMNS)
