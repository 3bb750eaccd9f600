"""Written stages: cut lineage with a Parquet table in the shared folder.

A stage outlives the executors that produced it, is read back column by column,
and has an exact, measurable size.  Stages go when the session's JVM ends, or
earlier by ``discard``.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Writers hold a row group in memory and readers a column of one; stages are read whole, so small ones cost nothing.
ROW_GROUP_BYTES = 16 << 20
# Vectored reads fill heap buffers from threads that keep a direct buffer as large as the largest column chunk they ever read.
VECTORED_READS = "parquet.hadoop.vectored.io.enabled"


def plain_reads(spark: SparkSession) -> None:
    """From here on, Parquet files of the session are read by the tasks themselves, which keep no buffers."""
    spark.conf.set(VECTORED_READS, "false")


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; all executors must reach it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that does not exist yet, removed at the end of the session."""
    around = f"{shared_folder(spark)}/tsubo/{name}-{uuid.uuid4().hex}"
    files, folder = _file_system(spark, around)
    files.mkdirs(folder)  # only a folder that exists is noted for removal
    files.deleteOnExit(folder)
    return f"{around}/data"


def stage(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once and return the written table.

    ``files`` bounds the number of files, without a shuffle; for a result that is small in however many partitions it comes.
    """
    path = new_path(df.sparkSession, name)
    (df if files is None else df.coalesce(files)).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).option(VECTORED_READS, "false").parquet(path)


def discard(*stages: DataFrame) -> None:
    """Delete written stages that nothing reads any more, and let go of finished shuffles.

    Spark removes the files of a shuffle when the driver collects the last
    reference to it; a chain of stages as large as its input cannot wait for that.
    """
    for df in stages:
        spark = df.sparkSession
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        if "/tsubo/" not in path:
            raise ValueError(f"{path} is no stage")
        files, folder = _file_system(spark, path)
        files.delete(folder, True)
        spark.sparkContext._jvm.System.gc()


class Size(NamedTuple):
    rows: int
    bytes: int


def measure(df: DataFrame) -> Size:
    """Exact row count and uncompressed size of a flat table (one aggregate job)."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"{field.name}: only flat columns can be measured")
        else:
            width = width + 16
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return Size(row["n"], row["size"])
