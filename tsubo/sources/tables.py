"""Table and file sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"
LISTINGS_RAW_SCHEMA = (
    "title STRING, address STRING, building_age STRING, building_size STRING, stations STRING, "
    "nearest_station STRING, distance_to_nearest_station BIGINT, avg_distance_to_stations DOUBLE, url STRING, "
    "rent STRING, management_fee STRING, deposit STRING, key_money STRING, floor STRING, floor_plan STRING, area STRING"
)
LISTINGS_CLEAN_SCHEMA = (
    "url STRING, title STRING, address STRING, rent DOUBLE, management_fee DOUBLE, deposit DOUBLE, key_money DOUBLE, "
    "floor BIGINT, floor_plan STRING, area DOUBLE, building_age BIGINT, building_size BIGINT, nearest_station STRING, "
    "distance_to_nearest_station BIGINT, avg_distance_to_stations DOUBLE, avg_rent_by_station DOUBLE, "
    "avg_rent_by_floor_plan DOUBLE, count_listings_per_station BIGINT, count_listings_per_floor_plan BIGINT"
)

BYTE_ORDER_MARK = "\ufeff"
ROWS_PER_FILE = 1_000_000

# One dialect for both directions: quotes doubled, line breaks kept inside
# quotes, blanks kept.  Empty text reads back as missing.
CSV_DIALECT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def planned_bytes(df: DataFrame) -> int:
    """The plan's own estimate of its size; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a small input to all cores.

    For work that costs far more than moving its input.  The size is the
    plan's own estimate: no job runs, and a large table is not moved.
    """
    if df.isStreaming:
        return df
    session = df.sparkSession
    split = int(session._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    cores = session.sparkContext.defaultParallelism
    return df.repartition(cores) if planned_bytes(df) < cores * split else df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Collected pages from Parquet."""
    return spark.read.schema(PAGES_SCHEMA).parquet(path)


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Collected pages from text files, one whole page each; the file path is the URL."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def append_pages(*batches: DataFrame) -> DataFrame:
    """All batches of a crawl as one bag; a page fetched twice stays twice."""
    every = batches[0]
    for batch in batches[1:]:
        every = every.unionByName(batch, allowMissingColumns=True)
    return every


def read_csv(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """Headed CSV; a byte-order mark is skipped, empty fields are NULL, and so are NaN numbers.

    Without a schema the types are inferred, which reads the files once more.
    ``multi_line`` is for text with line breaks inside quotes: each file is then
    one task; otherwise a large file is split.
    """
    reader = spark.read.options(**CSV_DIALECT).option("multiLine", multi_line)
    rows = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return rows.withColumns({c: F.nanvl(c, F.lit(None).cast(t)) for c, t in rows.dtypes if t in ("double", "float")})


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """Headed CSV.  With ``byte_order_mark`` every file starts with one.

    Files are bounded in rows because text with line breaks makes a CSV file
    unsplittable for its reader.
    """
    if byte_order_mark:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    df.write.mode("overwrite").options(**CSV_DIALECT).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace catalog table ``name``, schema included, and return it."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Replace temporary view ``name`` with the lazy plan of ``df``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
