"""From raw listing rows to typed, distinct listings, one row per floor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsubo.functions import labels, numbers

DUPLICATE_KEY = ["title", "floor", "floor_plan", "area", "rent"]
STANDARD_COLUMNS = [
    "url", "title", "address", "rent", "management_fee", "deposit", "key_money", "floor", "floor_plan", "area",
    "building_age", "building_size", "stations", "nearest_station", "distance_to_nearest_station",
    "avg_distance_to_stations",
]
FEE_COLUMNS = ["management_fee", "deposit", "key_money"]
FLOORS_PER_STEP = 1024


def dedup_listings(raw: DataFrame) -> DataFrame:
    """One row per duplicate key: the one with the smallest URL (NULL first).

    The other columns break URL ties, so the result does not depend on the
    partitioning.  ``rn = 1`` is planned as a partial group limit before the
    shuffle: a hot key sends one row per task, not its whole group.  The hash
    in front makes both sorts compare one number instead of five texts.
    """
    ties = [c for c in raw.columns if c not in DUPLICATE_KEY and c != "url"]
    first = Window.partitionBy("key_hash", *DUPLICATE_KEY).orderBy("url", *ties)
    hashed = raw.withColumn("key_hash", F.xxhash64(*DUPLICATE_KEY))
    return hashed.withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn", "key_hash")


def standardize(raw: DataFrame) -> DataFrame:
    """Typed columns from the raw labels; zero fees stay zero here."""
    typed = {
        "rent": numbers.man_yen(F.col("rent")),
        "management_fee": numbers.yen(F.col("management_fee")),
        "deposit": numbers.man_yen(F.col("deposit")),
        "key_money": numbers.man_yen(F.col("key_money")),
        "floor": labels.floor_label(F.col("floor")),
        "floor_plan": labels.floor_plan(F.col("floor_plan")),
        "area": numbers.square_metres(F.col("area")),
        "building_age": labels.building_age(F.col("building_age")),
        "building_size": labels.building_size_label(F.col("building_size")),
        "avg_distance_to_stations": F.round("avg_distance_to_stations", 2),
    }
    return raw.select([typed.get(c, F.col(c)).alias(c) for c in STANDARD_COLUMNS])


def nullify_zero_fees(standard: DataFrame) -> DataFrame:
    return standard.withColumns({c: numbers.zero_to_null(F.col(c)) for c in FEE_COLUMNS})


def _with_range(listings: DataFrame) -> DataFrame:
    split = listings.withColumn("_parts", labels.floor_parts(F.col("floor")))
    low, high = labels.floor_range(F.col("_parts"))
    return split.withColumns({"_low": low, "_high": high})


def explode_floors(listings: DataFrame, step: int = FLOORS_PER_STEP) -> DataFrame:
    """One row per floor; labels without a reading and descending ranges give none.

    The range is opened in two steps so that no single array grows with the
    label, however wide the range is.  The outer form plus a filter on the
    result keeps the parsing from being repeated in a filter below it.
    """
    starts = labels.floors_from(F.col("_low"), F.col("_high"), step)
    stepped = _with_range(listings).withColumn("_from", F.explode_outer(starts))
    last = F.coalesce(F.try_add(F.col("_from"), F.lit(step - 1).cast("bigint")), F.col("_high"))
    floors = F.sequence("_from", F.least(last, F.col("_high")))
    others = [c for c in listings.columns if c != "floor"]
    opened = stepped.select(*others, F.explode_outer(floors).alias("floor"))
    return opened.na.drop(subset=["floor"]).select(listings.columns)


def floor_rejects(listings: DataFrame) -> DataFrame:
    """How many listings keep or lose their floor, by reason: counted, never lost unseen."""
    readable = F.try_subtract(F.col("_high"), F.col("_low")) < labels.WIDEST_RANGE
    outcome = (
        F.when(F.array_contains("_parts", ""), "missing")
        .when(F.col("_high") < F.col("_low"), "descending")
        .when(readable, "kept")
        .otherwise("unreadable")
    )
    return _with_range(listings).groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("listings"))


def total_building_size(listings: DataFrame) -> DataFrame:
    return listings.withColumn("building_size", labels.building_size_total(F.col("building_size")))


def ground_floor_to_first(listings: DataFrame) -> DataFrame:
    return listings.withColumn("floor", labels.ground_floor_to_first(F.col("floor")))
