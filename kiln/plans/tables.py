"""Loading the test tables and the shared front of every document query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.config import FilterConfig
from kiln.operators.filters import quality_filter, quality_metrics
from kiln.sources.corpus import conform, spread

# How the test tables' columns map onto the document schema.
TEST_RENAMES = {"lang": "language", "source": "dump"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_partitions(spark: SparkSession) -> int | None:
    """Tasks over which scans of few large files are dealt (``spark.kiln.scanPartitions``; unset: none)."""
    value = spark.conf.get("spark.kiln.scanPartitions", None)
    return int(value) if value else None


def conformed(df: DataFrame) -> DataFrame:
    """Rows of the test table ``documents`` in the ten-column schema; its doc_id is the corpus order."""
    return conform(df, seq=F.col("doc_id"), renames=TEST_RENAMES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(spread(table(spark, sf_dir, "documents"), scan_partitions(spark)))


def metrics(spark: SparkSession, sf_dir: str, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    return quality_metrics(documents(spark, sf_dir), cfg)


def kept(spark: SparkSession, sf_dir: str, cfg: FilterConfig = FilterConfig()) -> DataFrame:
    """Documents that pass the quality filter: the input of dedup."""
    return quality_filter(documents(spark, sf_dir), cfg)
