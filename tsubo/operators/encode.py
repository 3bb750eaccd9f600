"""One-hot columns and standard scores."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsubo.operators.lookup import attach
from tsubo.operators.ranking import numbered
from tsubo.sources.staging import stage

# A table of columns cannot usefully be wider; entries, vectors and the regression have no such limit.
WIDEST_ENCODING = 2000


def categories(train: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of the training rows (few enough to become columns)."""
    rows = train.select(column).na.drop().distinct().limit(WIDEST_ENCODING + 1).collect()
    if len(rows) > WIDEST_ENCODING:
        raise ValueError(f"{column} has more than {WIDEST_ENCODING} values: use one_hot_entries or one_hot_vector")
    return sorted(row[0] for row in rows)


def feature_names(column: str, values: list[str]) -> list[str]:
    """Names of the dummy columns; the first category is the baseline and has none."""
    return [f"{column}_{value}" for value in values[1:]]


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Dummy columns next to the rows; an unknown value equals the baseline: all zeros."""
    dummies = {
        name: F.coalesce((F.col(column) == value).cast("double"), F.lit(0.0))
        for name, value in zip(feature_names(column, values), values[1:], strict=True)
    }
    return df.withColumns(dummies)


def category_slots(train: DataFrame, column: str) -> DataFrame:
    """``column, slot`` of every distinct value of the training rows, in order; slot 0 is the baseline.

    A dense rank for any number of categories: the distinct values are dealt to
    ranges of their order and numbered by sums over the ranges.
    """
    values = stage(train.select(column).na.drop().distinct(), "categories")
    return stage(numbered(values, [], [F.col(column)], "slot"), "category_slots")


def one_hot_entries(df: DataFrame, column: str, slots: DataFrame) -> DataFrame:
    """The entries that are 1: the rows' other columns with ``slot`` and ``value``, however many slots there are.

    The baseline and values that ``slots`` lacks have no entry.
    """
    return attach(df, slots.filter(F.col("slot") > 0), [column], "inner").withColumn("value", F.lit(1.0))


def one_hot_vector(df: DataFrame, column: str, slots: DataFrame, output: str) -> DataFrame:
    """The same encoding as one sparse vector; the baseline and unknown values are all zeros.

    The index of a known value is its slot less one; the baseline and whatever is
    unknown take the last index, which the encoder leaves out.  The driver
    learns the number of slots and no more.
    """
    # An encoder needs two slots at least: without two categories the vector is one zero.
    last = max(slots.agg(F.max("slot")).first()[0] or 0, 1)
    index = f"{column}_index"
    found = attach(df, slots, [column]).withColumn(index, F.when(F.col("slot") > 0, F.col("slot") - 1).otherwise(last).cast("double")).drop("slot")
    # Fitted on the largest index alone.
    sizes = df.sparkSession.range(1).select(F.lit(float(last)).alias(index))
    encoder = OneHotEncoder(inputCol=index, outputCol=output, dropLast=True).fit(sizes)
    return encoder.transform(found).drop(index)


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """One vector column from the feature columns, in the given order."""
    return VectorAssembler(inputCols=features, outputCol=output, handleInvalid="error").transform(df)


def scaling(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and divisor (population deviation, 1 without variance) per feature, from one pass."""
    row = df.agg(
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(features)),
        *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)),
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(features)}


def _score(column: str, scale: dict[str, tuple[float, float]]) -> Column:
    mean, divisor = scale[column]
    return (F.col(column) - F.lit(mean)) / F.lit(divisor)


def standardize_features(df: DataFrame, features: list[str], refit_on_test: bool = False) -> DataFrame:
    """Standard scores by the training rows' mean and deviation.

    With ``refit_on_test`` the test rows use their own mean and deviation.
    """
    train = scaling(df.filter(~F.col("is_test")), features)
    test = scaling(df.filter("is_test"), features) if refit_on_test else train
    return df.withColumns({c: F.when(F.col("is_test"), _score(c, test)).otherwise(_score(c, train)) for c in features})
