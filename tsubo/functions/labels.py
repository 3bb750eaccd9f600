"""Floor, floor-plan, building-age and building-size labels."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tsubo.functions.numbers import ascii_digits, lenient_bigint, without

# Label texts and units in the raw listings.
FLOOR_SUFFIX = "階"
STUDIO, STUDIO_PLAN = "ワンルーム", "1R"
NEW_BUILDING = "新築"
OR_MORE = "以上"
AGE_PREFIX, AGE_SUFFIX, AGE_SUFFIX_OR_MORE = "築", "年", "年以上"
ONE_STOREY, ONE_STOREY_SIZE = "平屋", "1"
SIZE_SUFFIX_CHARACTERS = "階建"
BASEMENT = "B"

# A wider range than this cannot be listed as one array by any engine.
WIDEST_RANGE = 2_000_000_000


def floor_label(text: Column) -> Column:
    """Trailing ``階`` characters removed."""
    return F.rtrim(text, F.lit(FLOOR_SUFFIX))


def floor_plan(text: Column) -> Column:
    return F.when(text == STUDIO, F.lit(STUDIO_PLAN)).otherwise(text)


def building_age(text: Column) -> Column:
    """Years; 0 for a new building."""
    return (
        F.when(text.contains(NEW_BUILDING), F.lit(0).cast("bigint"))
        .when(text.endswith(OR_MORE), lenient_bigint(without(without(text, AGE_PREFIX), AGE_SUFFIX_OR_MORE)))
        .otherwise(lenient_bigint(without(without(text, AGE_PREFIX), AGE_SUFFIX)))
    )


def building_size_label(text: Column) -> Column:
    """Storey text: any trailing characters of the set are stripped, not the word."""
    return F.when(text.contains(ONE_STOREY), F.lit(ONE_STOREY_SIZE)).otherwise(
        F.rtrim(text, F.lit(SIZE_SUFFIX_CHARACTERS))
    )


def building_size_total(text: Column) -> Column:
    """Sum of every digit run: ``'地下1地上3'`` to 4; 0 without digits, NULL where a run or the sum passes BIGINT."""
    runs = F.regexp_extract_all(ascii_digits(text), F.lit(r"(\d+)"), F.lit(1))
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda total, run: F.try_add(total, run.try_cast("bigint")))


class FloorRange(NamedTuple):
    low: Column
    high: Column


def floor_parts(text: Column) -> Column:
    return F.split(F.upper(ascii_digits(text)), "-")


def floor_range(parts: Column) -> FloorRange:
    """First and last floor of a split label; both NULL where it has no reading.

    ``'3'`` is 3..3, ``'B1-2'`` is -1..2.  Only the first part may name a
    basement and parts after the second are ignored.
    """
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    low = F.when(first.startswith(BASEMENT), -F.substring(first, 2, 2**31 - 1).try_cast("bigint")).otherwise(
        first.try_cast("bigint")
    )
    high = F.when(F.size(parts) == 1, low).otherwise(second.try_cast("bigint"))
    complete = ~F.array_contains(parts, "")
    return FloorRange(F.when(complete, low), F.when(complete, high))


def floors_from(low: Column, high: Column, step: int = 1) -> Column:
    """Every ``step``-th floor of a range; NULL for an unreadable label, empty for a descending range."""
    return F.when(F.try_subtract(high, low) < 0, F.array().cast("array<bigint>")).when(
        F.try_subtract(high, low) < WIDEST_RANGE, F.sequence(low, high, F.lit(step).cast("bigint"))
    )


def floor_list(text: Column) -> Column:
    """All floors of a label as an array."""
    return floors_from(*floor_range(floor_parts(text)))


def ground_floor_to_first(floor: Column) -> Column:
    """0 to 1, for modelling only."""
    return F.when(floor == 0, F.lit(1).cast("bigint")).otherwise(floor)
