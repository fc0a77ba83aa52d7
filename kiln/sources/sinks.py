"""Report and packed-array sinks S11-S13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> None:
    """A small report (one row, or a top-k list) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_packed(blocks: DataFrame, path: str, files: int | None = None) -> None:
    """Packed blocks as Parquet, one folder per split, each cut into files by block range."""
    keys = ["split", "block"]
    ranged = blocks.repartitionByRange(files, *keys) if files else blocks.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("split").parquet(path)


def read_packed(spark: SparkSession, path: str, split: str | None = None, check: bool = True) -> DataFrame:
    """Packed blocks; with ``check`` every row must hold three arrays of one length."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)  # partition pruning
    if check:
        bad = df.where(
            (F.size("input_ids") != F.size("labels")) | (F.size("labels") != F.size("loss_mask"))
        ).limit(1).count()
        if bad:
            raise ValueError("input_ids, labels and loss_mask differ in length")
    return df
