"""Written tables that several reports of one session read: built once per input.

The reports read the clean table the way separate notebooks read one hand-off
file.  An entry is tied to the session and to the state of the input files, and
is written again if its files are gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tsubo.operators import cleaning, regression
from tsubo.operators.features import featured
from tsubo.operators.split import train_test_split
from tsubo.plans import fixtures, listings
from tsubo.sources.staging import new_path, stage
from tsubo.sources.tables import read_table

_written: dict[tuple, tuple[str, StructType]] = {}


def _input_state(spark: SparkSession, folder: str, table: str) -> tuple:
    """Number, size and latest change of a table's files, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder.rstrip('/')}/{table}.parquet")
    row = files.agg(F.count("path"), F.sum("length"), F.max("modificationTime")).first()
    return tuple(map(str, row))


def _prepared(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name, _input_state(spark, folder, "lineitem"))
    if key in _written:
        path, schema = _written[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            del _written[key]
    df = build()
    path = new_path(spark, name)
    df.write.parquet(path)
    _written[key] = (path, df.schema)
    return spark.read.schema(df.schema).parquet(path)


def raw(spark: SparkSession, folder: str, copies_together: bool = False) -> DataFrame:
    return fixtures.raw_listings(read_table(spark, folder, "lineitem"), copies_together)


def standard(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct listings with typed columns."""
    return _prepared(spark, folder, "standard", lambda: listings.standard_listings(raw(spark, folder, copies_together=True)))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    """One row per listing and floor, with all features."""
    return _prepared(spark, folder, "clean", lambda: listings.clean_listings(featured(standard(spark, folder))))


def split(spark: SparkSession, folder: str) -> DataFrame:
    """The clean table split for modelling, with the ground floor as the first."""
    columns = ["url", "rent", "area", "building_age", "building_size", "floor", "floor_plan"]

    def build() -> DataFrame:
        rows = stage(regression.complete_rows(clean(spark, folder)).select(columns), "complete")
        return train_test_split(rows, "url", "floor").transform(cleaning.ground_floor_to_first)

    return _prepared(spark, folder, "split", build)


def model(spark: SparkSession, folder: str) -> regression.Fit:
    return regression.fit(regression.moments(split(spark, folder)))


def forget(spark: SparkSession) -> None:
    """Build everything anew from here on."""
    for key in [k for k in _written if k[0] == spark.sparkContext.applicationId]:
        del _written[key]
