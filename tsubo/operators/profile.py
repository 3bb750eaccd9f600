"""Column profile and summary statistics of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsubo.operators.quantiles import quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column_profile(df: DataFrame) -> DataFrame:
    """Name, non-null count and type of every column, from one aggregate row."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.col(f.name).alias("non_null"), F.lit(f.dataType.simpleString()).alias("type")
        )
        for f in df.schema.fields
    ]
    return counts.select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, **limits) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    The moments of all columns come from one aggregate row; only the quartiles
    need the cells one by one, keyed by column number.
    """
    columns = numeric_columns(df)
    moments = df.agg(
        *(
            F.expr(
                f"named_struct('column_name', '{c}', 'count', count(`{c}`), 'mean', avg(`{c}`), "
                f"'std', stddev_samp(`{c}`), 'min', double(min(`{c}`)), 'max', double(max(`{c}`))) AS `{c}`"
            )
            for c in columns
        )
    ).first()
    cells = df.selectExpr("posexplode(array(" + ", ".join(f"double(`{c}`)" for c in columns) + ")) AS (place, value)")
    rows = sum(moments[c]["count"] for c in columns)
    quartiles = quantiles(cells, ["place"], "value", [0.25, 0.5, 0.75], rows=rows, **limits)
    described = df.sparkSession.createDataFrame(
        [(i, *moments[c]) for i, c in enumerate(columns)],
        "place INT, column_name STRING, count BIGINT, mean DOUBLE, std DOUBLE, min DOUBLE, max DOUBLE",
    )
    # One row per column of the table on either side.
    return described.join(F.broadcast(quartiles), "place", "left").selectExpr(
        "column_name", "count", "mean", "std", "min", "max", "quantiles[0] AS q25", "quantiles[1] AS q50", "quantiles[2] AS q75"
    )


def describe_text(df: DataFrame) -> DataFrame:
    """Count, distinct count, most frequent value and its frequency per text column.

    Of equally frequent values the smallest is reported.
    """
    columns = text_columns(df)
    pairs = ", ".join(f"struct('{c}' AS column_name, `{c}` AS value)" for c in columns)
    cells = df.selectExpr(f"inline(array({pairs}))").na.drop(subset=["value"])
    frequency = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # min_by on the negated count: ties go to the smaller text.
    return frequency.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
