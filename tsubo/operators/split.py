"""Repeatable train/test split and cross-validation folds of exact size.

The hash order of the row keys plays the part of a seeded permutation: the test
set is its first stretch, the training set the rest, and the folds are equal
consecutive stretches of the training set.  No row is ranked: the few hash
values at the borders are found, and every row is compared with them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.functions.keys import ORDER_BITS, shuffle_order
from tsubo.sources.staging import stage

TEST_SHARE = 0.2
FOLDS = 5
LEVEL_BITS = 15
ROWS_ON_DRIVER = 100_000


def values_at_ranks(df: DataFrame, order: str, ranks: list[int]) -> list[int]:
    """The ``order`` values (60-bit, non-negative) at the given zero-based ranks.

    Each pass counts rows per leading bits and follows the few prefixes that
    hold a rank; the driver sees at most 2**15 counts per rank.  The passes end
    early when the rows left are few.
    """
    open_ranks = {0: [(rank, rank) for rank in ranks]}  # prefix -> (rank asked, rank within the prefix)
    found: dict[int, int] = {}
    for shift in range(ORDER_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        upper = F.shiftright(order, shift + LEVEL_BITS)
        kept = df.filter(upper.isin(list(open_ranks)))
        counted = kept.groupBy(F.shiftright(order, shift).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()
        narrowed: dict[int, list[tuple[int, int]]] = {}
        sizes: dict[int, int] = {}
        for parent, wanted in open_ranks.items():
            rows = sorted((r["prefix"], r["n"]) for r in counted if r["prefix"] >> LEVEL_BITS == parent)
            upto = np.cumsum([n for _, n in rows])
            for asked, rank in wanted:
                i = int(np.searchsorted(upto, rank, side="right"))
                before = int(upto[i]) - rows[i][1]
                narrowed.setdefault(rows[i][0], []).append((asked, rank - before))
                sizes[rows[i][0]] = rows[i][1]
        open_ranks = narrowed
        if shift == 0:
            found.update({asked: prefix for prefix, wanted in open_ranks.items() for asked, _ in wanted})
        elif sum(sizes.values()) <= ROWS_ON_DRIVER:
            left = df.filter(F.shiftright(order, shift).isin(list(open_ranks))).select(order).collect()
            for prefix, wanted in open_ranks.items():
                inside = sorted(r[0] for r in left if r[0] >> shift == prefix)
                found.update({asked: inside[rank] for asked, rank in wanted})
            break
    return [found[rank] for rank in ranks]


def _cuts_in_ties(ordered: DataFrame, borders: dict[int, int]) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """``ordered`` with ``_row`` and ``_copy``, and their values at each border rank that cuts rows of one ``_order``.

    Only rows of the orders so cut are written; a hash of the whole row, then
    the number written with each copy, decides among them.
    """
    order = F.col("_order")
    values = sorted(set(borders.values()))
    if not values:
        return ordered, {}
    upto = [F.count_if(order < v) for v in values] + [F.count_if(order <= v) for v in values]
    counts = ordered.agg(*(c.alias(f"_{i}") for i, c in enumerate(upto))).first()
    below, through = dict(zip(values, counts[: len(values)], strict=True)), dict(zip(values, counts[len(values) :], strict=True))
    cut = {rank: v for rank, v in borders.items() if rank + 1 < through[v]}
    if not cut:
        return ordered, {}
    at_cut = order.isin(sorted(set(cut.values())))
    whole = shuffle_order(*(F.col(c) for c in ordered.columns))
    tied = stage(ordered.filter(at_cut).withColumns({"_row": whole, "_copy": F.monotonically_increasing_id()}), "tied")
    found = {}
    for rank, v in cut.items():
        same, inside = tied.filter(order == v), rank - below[v]
        row = values_at_ranks(same.select("_row"), "_row", [inside])[0]
        inside -= same.filter(F.col("_row") < row).count()
        found[rank] = (row, values_at_ranks(same.filter(F.col("_row") == row).select("_copy"), "_copy", [inside])[0])
    untied = ordered.filter(~at_cut).withColumns({"_row": F.lit(0).cast("bigint"), "_copy": F.lit(0).cast("bigint")})
    return untied.unionByName(tied), found


def train_test_split(
    df: DataFrame, *key: Column | str, test_share: float = TEST_SHARE, folds: int = FOLDS
) -> DataFrame:
    """Adds ``is_test`` and, for training rows, ``fold``.

    The test set has ``ceil(share * n)`` rows and fold sizes differ by one at
    most, whatever the keys: rows of one key stay together, unless a border
    falls among them.  ``df`` should read a written table.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in key]
    ordered = df.withColumn("_order", shuffle_order(*columns))
    rows = df.count()
    test_rows = math.ceil(test_share * rows)
    train_rows = rows - test_rows
    sizes = [train_rows // folds + (i < train_rows % folds) for i in range(folds)]
    ends = [test_rows]
    for size in sizes[:-1]:
        ends.append(ends[-1] + size)
    wanted = sorted({end - 1 for end in ends if 0 < end <= rows})
    borders = dict(zip(wanted, values_at_ranks(ordered.select("_order"), "_order", wanted), strict=True)) if wanted else {}
    ordered, cuts = _cuts_in_ties(ordered, borders)

    def before(end: int) -> Column:
        """Whether a row is among the first ``end``."""
        limit = borders.get(end - 1, -1)
        if end - 1 not in cuts:
            return F.col("_order") <= limit
        row, copy = cuts[end - 1]
        inside = (F.col("_row") < row) | ((F.col("_row") == row) & (F.col("_copy") <= copy))
        return (F.col("_order") < limit) | ((F.col("_order") == limit) & inside)

    fold = F.when(before(ends[0]), F.lit(None).cast("int"))
    for i, end in enumerate(ends[1:]):
        fold = fold.when(before(end), F.lit(i))
    fold = fold.otherwise(F.lit(folds - 1))
    return ordered.select(*df.columns, before(ends[0]).alias("is_test"), fold.alias("fold"))
