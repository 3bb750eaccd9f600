"""Time the headline queries and print one JSON line.

Every query is run in full (a sink that discards its rows).  The reports read
tables that one session prepares once; building those is timed as its own
entry (``prepare_clean``, ``prepare_split``) and not hidden in a query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")

HEADLINE = [
    "dedup_listings", "standardize_money", "featured_view", "clean_listings", "explode_floors", "column_profile",
    "describe_numeric", "describe_text", "rent_confidence_interval", "correlation_matrix", "pearson_area_rent",
    "rent_histogram", "rent_kde", "box_by_floor_plan", "box_by_station", "train_test_split_counts",
    "one_hot_floor_plan", "standardize_features", "simple_regression", "cv_simple_r2", "cv_multiple_r2",
    "multiple_regression_scores", "coef_table", "residuals", "residual_histogram", "html_roundtrip_listings",
    "html_page_frontier", "page_links", "csv_roundtrip", "table_roundtrip",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tsubo-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tsubo-bench-"))
    from tsubo.plans import prepared, registry

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    if os.path.isdir(WARM_UP):
        run(registry.featured_view(spark, WARM_UP))
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)

    timed("prepare_clean", lambda: prepared.clean(spark, FOLDER))
    timed("prepare_split", lambda: prepared.split(spark, FOLDER))
    for name in HEADLINE:
        timed(name, lambda: run(registry.QUERIES[name](spark, FOLDER)))
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/"))[2:]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
