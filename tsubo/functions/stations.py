"""Station names and walking minutes from the text blocks of one building."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tsubo.functions.numbers import ascii_digits

# A block reads "line/station 歩N分".  (?U) and (?d) give the
# classes and the dot their Unicode meaning.
STATION_NAME = r"(?Ud)/(.*?)\s*歩"
DIGIT_RUN = r"(?U)(\d+)"
WALK_MINUTES = r"(?U)歩\s*(\d+)"


class StationSummary(NamedTuple):
    stations: Column
    nearest_station: Column
    distance_to_nearest_station: Column
    avg_distance_to_stations: Column


def _first_matches(blocks: Column, pattern: str) -> Column:
    """First match of each block; blocks without a match leave no entry."""
    found = F.transform(blocks, lambda b: F.slice(F.regexp_extract_all(b, F.lit(pattern), F.lit(1)), 1, 1))
    return F.flatten(found)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return F.try_divide(total, F.size(values).cast("double"))


def readings(blocks: Column, strict: bool = False) -> dict[str, Column]:
    """What the patterns find in the blocks.

    The summary uses every reading several times: made columns first, they are searched for once.
    """
    if strict:
        paired = F.filter(
            F.transform(
                blocks,
                lambda b, i: F.named_struct(
                    F.lit("minutes"), ascii_digits(F.regexp_extract(b, WALK_MINUTES, 1)).try_cast("bigint"),
                    F.lit("place"), i,
                    F.lit("name"), F.get(F.regexp_extract_all(b, F.lit(STATION_NAME), F.lit(1)), F.lit(0)),
                ),
            ),
            lambda s: s["minutes"].isNotNull() & s["name"].isNotNull(),
        )
        return {"paired": paired}
    runs = F.transform(
        _first_matches(blocks, DIGIT_RUN),
        lambda d: F.named_struct(F.lit("text"), d, F.lit("minutes"), ascii_digits(d).try_cast("bigint")),
    )
    return {"names": _first_matches(blocks, STATION_NAME), "runs": runs}


def summarize(blocks: Column, strict: bool = False, found: dict[str, Column] | None = None) -> StationSummary:
    """Joined text, nearest station, its minutes and the average minutes.

    By default names and minutes are two separately filtered lists matched by
    index, and the first digit run of a block counts as its minutes.  With
    ``strict`` only blocks that state both count and stay paired.  ``found`` are
    the columns that ``readings`` were made.
    """
    present = F.size(blocks) > 0
    joined = F.when(present, F.array_join(blocks, ","))
    found = found or readings(blocks, strict)
    if strict:
        nearest = F.array_min(found["paired"])
        return StationSummary(
            joined,
            F.when(present, nearest["name"]),
            F.when(present, nearest["minutes"]),
            F.when(present, _mean(found["paired"]["minutes"])),
        )
    names, runs = found["names"], found["runs"]
    least = F.array_min(runs["minutes"])
    place = F.array_position(runs["text"], least.cast("string")).cast("int")
    return StationSummary(
        joined,
        F.when(present, F.get(names, place - 1)),
        F.when(present, least),
        F.when(present, _mean(runs["minutes"])),
    )
