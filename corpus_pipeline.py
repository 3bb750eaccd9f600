"""The corpus pipeline: documents in, documents with sampling rates out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsubo.llm import decontaminate, jaccard_join, mixing, quality, secrets_scan
from tsubo.sources.staging import plain_reads, stage
from tsubo.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    plain_reads(spark)
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: five-word shingles, Jaccard 0.8 (op7 alone has its own contract)."""
    plain_reads(spark)
    return jaccard_join.one_per_class(docs, percent=80, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    plain_reads(spark)
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text."""
    plain_reads(spark)
    return secrets_scan.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens, domain posteriors and rate."""
    plain_reads(spark)
    return mixing.mix(docs, read_table(spark, sf_dir, "labels"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing_rates", mixing_rates),
]

# The last stage fits rates by iteration, which SQL does not express; tests hold the operators of the stages against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read again as the next one's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
