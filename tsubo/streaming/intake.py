"""Page intake as a stream: each newly collected page file is read once and appended.

The operators are the batch ones; extraction keeps no state, so the stream
needs neither watermark nor shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tsubo.operators.pages import extract_listings
from tsubo.sources.tables import PAGES_SCHEMA


def read_page_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_listings(pages: DataFrame, base_url: str, output: str, checkpoint: str) -> StreamingQuery:
    """Append the listings of all pages that have arrived, then stop; run again for later ones."""
    listings = extract_listings(pages, base_url)
    return (
        listings.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
