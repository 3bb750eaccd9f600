"""The listing pipeline: raw rows to the featured view and the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tsubo.operators import cleaning, features
from tsubo.sources.staging import stage


def standard_listings(raw: DataFrame) -> DataFrame:
    """Distinct listings with typed columns (lazy; one shuffle)."""
    return raw.transform(cleaning.dedup_listings).transform(cleaning.standardize)


def featured_view(raw: DataFrame) -> DataFrame:
    """The 19-column listing view.

    The distinct listings are written before the features: the view reads them
    twice, once narrow for the group sums and once whole, and neither reading
    may repeat the shuffle.
    """
    return features.featured(stage(standard_listings(raw), "standard"))


def clean_listings(view: DataFrame) -> DataFrame:
    """One row per listing and floor, with the total building size."""
    return view.transform(cleaning.explode_floors).transform(cleaning.total_building_size)
