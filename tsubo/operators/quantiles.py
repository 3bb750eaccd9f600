"""Exact grouped quantiles (linear interpolation) of any group size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsubo.operators.lookup import BROADCAST_BYTES, attach
from tsubo.sources.staging import stage

# So many different values are put in order at once, in one task; more are narrowed first.
MOST_VALUES = 1_000_000
# An interval is cut into this many, a power of two, per round; the sketch errs by a thousandth of the values.
PARTS, ACCURACY = 64, 1000


def quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probabilities: list[float],
    rows: int | None = None,
    most_values: int = MOST_VALUES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``by`` columns plus ``quantiles``, an array with one value per probability.

    NULL values are skipped and NULL keys form a group.  Equal values of a group
    are counted first, before and after one shuffle.  A group of at most
    ``most_values`` different values is finished by the built-in aggregate over
    these counts.  In a larger one the wanted ranks are located: its values are cut
    at sketched quantiles, the parts are counted, and only parts that hold a wanted
    rank go on, round by round until they are small enough to be put in order.
    The cuts balance the work and cannot change the result.  ``df`` should read a written table
    (its rows are counted here unless ``rows`` says how many).
    """
    # The keys get names of their own, so that they cannot meet a working column; the first makes the whole table a group.
    keys = ["_all", *(f"_by{i}" for i in range(len(by)))]
    values = df.select(F.lit(0).alias("_all"), *(F.col(c).alias(k) for c, k in zip(by, keys[1:], strict=True)), F.col(value).cast("double").alias("value"))
    values = values.na.drop(subset=["value"])
    wanted = F.array(*(F.lit(float(p)) for p in probabilities))
    rows = df.count() if rows is None else rows
    if rows <= most_values:  # then no group has more values
        found = values.groupBy(*keys).agg(F.percentile("value", wanted).alias("quantiles"))
    else:
        cells = stage(values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")), "value_counts")
        sizes = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("total"))
        wide = stage(sizes.filter(F.col("values") > most_values).select(*keys, "total"), "wide_groups")
        marked = attach(cells, wide, keys, broadcast_bytes=broadcast_bytes)
        found = marked.filter("total IS NULL").groupBy(*keys).agg(F.percentile("value", wanted, F.col("n")).alias("quantiles"))
        if not wide.isEmpty():
            large = marked.filter("total IS NOT NULL").drop("total")
            found = found.unionByName(_by_rank(large, keys, _ranks(wide, keys, probabilities), most_values, broadcast_bytes))
    return found.drop("_all").withColumnsRenamed(dict(zip(keys[1:], by, strict=True)))


def _ranks(groups: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``*keys, place, rank, weight``: two neighbouring ranks per probability, weighted by the fraction between them."""
    position = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    pairs = F.array(*(F.struct(F.lit(i).alias("place"), p.alias("position"), F.lit(side).alias("side")) for i, p in enumerate(position) for side in (0, 1)))
    opened = groups.withColumn("w", F.explode(pairs)).select(*keys, "total", "w.*")
    rank = F.least(F.floor("position") + F.col("side"), F.col("total") - 1)
    weight = F.abs(1 - F.col("side") - (F.col("position") - F.floor("position")))
    return opened.select(*keys, "place", rank.alias("rank"), weight.alias("weight"))


def _part(cuts: list[Column], low: int, high: int) -> Column:
    """How many of the ascending cuts are not above the value, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.col("value") < cuts[middle], _part(cuts, low, middle)).otherwise(_part(cuts, middle + 1, high))


def _by_rank(cells: DataFrame, keys: list[str], ranks: DataFrame, most_values: int, broadcast_bytes: int) -> DataFrame:
    """The quantiles from ``cells`` (``*keys, value, n``), where every group is too large to be put in order.

    ``part`` numbers the interval a row lies in; ``before`` counts the rows of its group below it.
    """
    within = [*keys, "part"]
    rows = cells.withColumn("part", F.lit(0).cast("decimal(38,0)"))
    targets = stage(ranks.withColumns({"part": F.lit(0).cast("decimal(38,0)"), "before": F.lit(0).cast("bigint")}), "ranks")
    done: list[tuple[DataFrame, DataFrame]] = []
    while True:
        sizes = rows.groupBy(*within).agg(F.count(F.lit(1)).alias("values"))
        wide = stage(sizes.filter(F.col("values") > most_values).select(*within, F.lit(True).alias("wide")), "wide_parts")
        if wide.isEmpty():
            done.append((rows, targets))
            break
        marked, open_ = (attach(t, wide, within, broadcast_bytes=broadcast_bytes) for t in (rows, targets))
        done.append((marked.filter("wide IS NULL").drop("wide"), open_.filter("wide IS NULL").drop("wide")))
        rows, targets = marked.filter("wide").drop("wide"), open_.filter("wide").drop("wide")

        names = [f"_cut{i}" for i in range(PARTS - 1)]
        sketch = F.percentile_approx("value", F.array(*(F.lit(i / PARTS) for i in range(1, PARTS))), F.lit(ACCURACY))
        cuts = rows.groupBy(*within).agg(sketch.alias("cuts")).select(*within, *(F.get("cuts", F.lit(i)).alias(c) for i, c in enumerate(names)))
        placed = attach(rows, stage(cuts, "cuts"), within, broadcast_bytes=broadcast_bytes)
        inner = _part([F.col(c) for c in names], 0, PARTS - 1)
        placed = stage(placed.select(*within, "value", "n", inner.alias("inner")), "parts")

        counts = placed.groupBy(*within, "inner").agg(F.sum("n").alias("here"))
        running = Window.partitionBy(*within).orderBy("inner").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("upto", F.sum("here").over(running)).select(*(F.col(k).alias(f"to_{k}") for k in within), "inner", "here", "upto")
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"to_{k}")) for k in within))
        offset = F.col("rank") - F.col("before")
        hit = targets.join(counts, same & (F.col("upto") - F.col("here") <= offset) & (offset < F.col("upto")))
        part = (F.col("part") * PARTS + F.col("inner")).cast("decimal(38,0)")
        hit = hit.select(*keys, "place", "rank", "weight", part.alias("part"), (F.col("before") + F.col("upto") - F.col("here")).alias("before"))
        targets = stage(hit, "ranks")
        rows = placed.select(*keys, "value", "n", part.alias("part"))
        rows = stage(attach(rows, targets.select(*within).distinct(), within, "left_semi", broadcast_bytes), "wanted_parts")
    return _values(reduce(DataFrame.unionByName, (r for r, _ in done)), reduce(DataFrame.unionByName, (t for _, t in done)), keys)


def _values(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Read the wanted ranks off parts that are small enough to be put in order."""
    within = [*keys, "part"]
    inside = Window.partitionBy(*within).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = rows.withColumn("upto", F.sum("n").over(inside)).withColumn("from", F.col("upto") - F.col("n"))
    renamed = targets.select([F.col(c).alias(f"to_{c}") for c in targets.columns])
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"to_{k}")) for k in within))
    offset = F.col("to_rank") - F.col("to_before")
    found = ordered.join(renamed, same & (F.col("from") <= offset) & (offset < F.col("upto")))
    # A weight of zero must not turn an infinite neighbour into NaN.
    share = F.when(F.col("to_weight") > 0, F.col("to_weight") * F.col("value")).otherwise(0.0)
    points = found.groupBy(*keys, "to_place").agg(F.sum(share).alias("point"))
    packed = points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("to_place", "point"))).alias("points"))
    return packed.select(*keys, F.transform("points", lambda p: p["point"]).alias("quantiles"))
