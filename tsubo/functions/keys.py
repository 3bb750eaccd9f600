"""Repeatable shuffle order: a hash of a row's key stands for a random permutation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_BITS = 60


def shuffle_order(*key: Column) -> Column:
    """First 60 bits of the MD5 of the key, as a non-negative BIGINT.

    The same under any partitioning, unlike ``rand``.
    """
    text = F.concat_ws("#", *(F.coalesce(part.cast("string"), F.lit("")) for part in key))
    return F.conv(F.substring(F.md5(text), 1, ORDER_BITS // 4), 16, 10).cast("bigint")
