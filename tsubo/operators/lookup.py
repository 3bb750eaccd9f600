"""Join a per-key summary back to its rows without gathering a hot key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.sources.staging import measure

# A summary up to this size is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond it, keys that hold at least this share of the rows are joined in slices; there are at most 1 / share of them.
HOT_SHARE = 1 / 500
SLICES = 64


def hot_hashes(keys: Column, rows: DataFrame, share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of ``rows``, and perhaps of a few more.

    A frequent-items summary of fixed size per task, merged: no shuffle, nothing grows with the input.
    """
    found = rows.select(F.xxhash64(keys).alias("hash")).freqItems(["hash"], share).first()
    return sorted(h for h in (found[0] or []) if h is not None)


def attach(
    rows: DataFrame,
    summary: DataFrame,
    keys: list[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    slices: int = SLICES,
) -> DataFrame:
    """Join ``summary`` (one row per key; NULL is a key) to ``rows``.

    The summary is measured first; it should derive from a small written stage,
    for it is computed again for the join.  Within ``broadcast_bytes`` it is
    broadcast and ``rows`` is not shuffled.  Beyond it, both sides are shuffled
    once by key, and only the keys that stand out in ``rows`` are split: their
    rows are dealt to ``slices`` by a hash of the whole row, the summary's row
    is repeated for these alone.  A retried task deals out the same slices.
    Equal rows of a hot key stay together.  ``rows`` is read once more to find
    the hot keys, so it too should be a written table.
    """
    renamed = summary.select([F.col(c).alias(f"_key_{c}" if c in keys else c) for c in summary.columns])
    small = measure(summary).bytes <= broadcast_bytes
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    if small:
        joined = rows.join(F.broadcast(renamed), reduce(lambda a, b: a & b, same), how)
        return joined.drop(*(f"_key_{k}" for k in keys))
    hot = hot_hashes(F.struct(*keys), rows)
    if hot:
        row, key = F.xxhash64(F.struct(*keys)), F.xxhash64(F.struct(*(F.col(f"_key_{k}").alias(k) for k in keys)))
        rows = rows.withColumn("_slice", F.when(row.isin(hot), F.pmod(F.xxhash64(F.struct("*")), F.lit(slices)).cast("int")).otherwise(0))
        every = F.sequence(F.lit(0), F.lit(slices - 1))
        renamed = renamed.withColumn("_key_slice", F.explode(F.when(key.isin(hot), every).otherwise(F.array(F.lit(0)))))
        same.append(F.col("_slice") == F.col("_key_slice"))
    joined = rows.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop("_slice", "_key_slice", *(f"_key_{k}" for k in keys))
