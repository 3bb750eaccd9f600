"""A stored listing view over a catalog table, with its label readings as SQL functions.

The view is text in the catalog: it holds no rows, creating it runs no job, and
whoever reads it, from any session of the catalog, sees the table as it then is.
The functions are stored beside it and are inlined by the optimizer, so the scan
stays column-pruned and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tsubo.functions import labels, numbers
from tsubo.operators.cleaning import DUPLICATE_KEY, FEE_COLUMNS
from tsubo.operators.features import FEATURED_COLUMNS
from tsubo.sources.tables import LISTINGS_RAW_SCHEMA

PREFIX = "tsubo_"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _call(name: str, *arguments: str) -> str:
    return f"{PREFIX}{name}({', '.join(arguments)})"


def _without(text: str, *found: str) -> str:
    for label in found:
        text = f"replace({text}, {_text(label)}, '')"
    return text


def _functions() -> dict[str, tuple[str, str]]:
    """Result type and body of every function of ``label``; later ones use earlier ones."""
    double = f"try_cast(regexp_extract(label, {_text(numbers.DOUBLE_PREFIX)}, 1) AS DOUBLE)"
    prefix = f"regexp_extract(label, {_text(numbers.INTEGER_PREFIX)}, 1)"
    saturated = f"CASE WHEN {prefix} = '' THEN 0 WHEN startswith({prefix}, '-') THEN {numbers.BIGINT_MIN + 1} - 1 ELSE {numbers.BIGINT_MAX} END"
    years = _without("label", labels.AGE_PREFIX)
    return {
        "double": ("DOUBLE", f"coalesce({double}, CASE WHEN label IS NOT NULL THEN 0D END)"),
        "bigint": ("BIGINT", f"coalesce(try_cast({prefix} AS BIGINT), CASE WHEN label IS NOT NULL THEN {saturated} END)"),
        "man_yen": ("DOUBLE", f"{_call('double', _without('label', numbers.MAN_YEN))} * {numbers.YEN_PER_MAN}"),
        "yen": ("DOUBLE", _call("double", _without("label", numbers.YEN))),
        "square_metres": ("DOUBLE", _call("double", _without("label", numbers.SQUARE_METRES))),
        "floor": ("STRING", f"rtrim({_text(labels.FLOOR_SUFFIX)}, label)"),
        "floor_plan": ("STRING", f"CASE label WHEN {_text(labels.STUDIO)} THEN {_text(labels.STUDIO_PLAN)} ELSE label END"),
        "building_age": (
            "BIGINT",
            f"CASE WHEN contains(label, {_text(labels.NEW_BUILDING)}) THEN 0 "
            f"WHEN endswith(label, {_text(labels.OR_MORE)}) THEN {_call('bigint', _without(years, labels.AGE_SUFFIX_OR_MORE))} "
            f"ELSE {_call('bigint', _without(years, labels.AGE_SUFFIX))} END",
        ),
        "building_size": (
            "STRING",
            f"CASE WHEN contains(label, {_text(labels.ONE_STOREY)}) THEN {_text(labels.ONE_STOREY_SIZE)} "
            f"ELSE rtrim({_text(labels.SIZE_SUFFIX_CHARACTERS)}, label) END",
        ),
    }


READINGS = {
    "rent": "man_yen", "management_fee": "yen", "deposit": "man_yen", "key_money": "man_yen", "floor": "floor",
    "floor_plan": "floor_plan", "area": "square_metres", "building_age": "building_age", "building_size": "building_size",
}


def create_label_functions(spark: SparkSession) -> None:
    """Store the label functions in the current database, replacing them."""
    for name, (kind, body) in _functions().items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {PREFIX}{name}(label STRING) RETURNS {kind} DETERMINISTIC RETURN {body}")


def drop_label_functions(spark: SparkSession) -> None:
    for name in reversed(_functions()):
        spark.sql(f"DROP FUNCTION IF EXISTS {PREFIX}{name}")


def featured_view_sql(table: str) -> str:
    """The 19-column listing view over raw listings, as one SELECT.

    Distinct listings are one window with a group limit below its shuffle; the
    figures per station and per plan are small sums joined back, not windows
    over whole rows.
    """
    columns = [part.split()[0] for part in LISTINGS_RAW_SCHEMA.split(", ")]
    ties = [c for c in columns if c not in DUPLICATE_KEY and c != "url"]
    typed = ", ".join(f"{_call(READINGS[c], c)} AS {c}" if c in READINGS else f"round({c}, 2) AS {c}" if c.startswith("avg_") else c for c in columns)

    def figures(key: str, suffix: str) -> str:
        return (
            f"SELECT {key} AS of_{suffix}, round(try_divide(sum(rent), count(rent)), 2) AS avg_rent_by_{suffix}, "
            f"count(title) AS count_listings_per_{suffix} FROM listings GROUP BY {key}"
        )

    shown = ", ".join(f"nullif({c}, 0D) AS {c}" if c in FEE_COLUMNS else c for c in FEATURED_COLUMNS)
    return f"""WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(DUPLICATE_KEY)} ORDER BY url, {", ".join(ties)}) AS copy FROM {table}
), listings AS (SELECT {typed} FROM numbered WHERE copy = 1),
stations AS ({figures("nearest_station", "station")}),
plans AS ({figures("floor_plan", "floor_plan")})
SELECT {shown} FROM listings LEFT JOIN stations ON nearest_station <=> of_station LEFT JOIN plans ON floor_plan <=> of_floor_plan"""


def create_featured_view(spark: SparkSession, table: str, view: str) -> None:
    """Store ``view`` over catalog table ``table``; whatever view had the name is dropped first.  No job runs."""
    create_label_functions(spark)
    spark.sql(f"DROP VIEW IF EXISTS {view}")
    spark.sql(f"CREATE VIEW {view} AS {featured_view_sql(table)}")


def append_rows(rows: DataFrame, table: str) -> None:
    """Add rows to a catalog table, columns by name."""
    rows.select(rows.sparkSession.table(table).columns).write.insertInto(table)
