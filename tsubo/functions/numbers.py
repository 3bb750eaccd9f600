"""Lenient numeric casts and the money and area labels built on them.

A text label is read the way the source data was written: the longest numeric
prefix counts, text without one counts as zero, and only NULL stays NULL.  ANSI
``cast`` would fail the job on the first odd label and ``try_cast`` would turn
``'3.5x'`` into NULL, so neither can be used alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric prefixes a lenient cast accepts.
DOUBLE_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
INTEGER_PREFIX = r"^\s*([+-]?\d+)"

# Unit labels in the raw text.
MAN_YEN = "万円"
YEN = "円"
SQUARE_METRES = "m2"
YEN_PER_MAN = 10000

# Full-width digits read like ASCII ones.
WIDE_DIGITS = "０１２３４５６７８９"
ASCII_DIGITS = "0123456789"

BIGINT_MAX = 2**63 - 1
BIGINT_MIN = -(2**63)


def lenient_double(text: Column) -> Column:
    """Longest numeric prefix as DOUBLE, 0.0 without one, NULL for NULL."""
    value = F.regexp_extract(text, DOUBLE_PREFIX, 1).try_cast("double")
    return F.coalesce(value, F.when(text.isNotNull(), F.lit(0.0)))


def lenient_bigint(text: Column) -> Column:
    """Longest integer prefix as BIGINT, saturating; 0 without one, NULL for NULL."""
    prefix = F.regexp_extract(text, INTEGER_PREFIX, 1)
    saturated = F.when(prefix == "", F.lit(0)).when(prefix.startswith("-"), F.lit(BIGINT_MIN)).otherwise(F.lit(BIGINT_MAX))
    return F.coalesce(prefix.try_cast("bigint"), F.when(text.isNotNull(), saturated))


def without(text: Column, label: str) -> Column:
    """Every literal occurrence of ``label`` removed."""
    return F.replace(text, F.lit(label), F.lit(""))


def man_yen(text: Column) -> Column:
    """``'8.3万円'`` to yen."""
    return lenient_double(without(text, MAN_YEN)) * F.lit(YEN_PER_MAN)


def yen(text: Column) -> Column:
    """``'5000円'`` to yen."""
    return lenient_double(without(text, YEN))


def square_metres(text: Column) -> Column:
    """``'25.5m2'`` to square metres."""
    return lenient_double(without(text, SQUARE_METRES))


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, WIDE_DIGITS, ASCII_DIGITS)
