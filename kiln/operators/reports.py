"""Filter reports A1-A4 over the output of ``quality_metrics``.

Each is an aggregate with map-side partial aggregation; none gathers rows
on the driver.  Top-k examples use ``orderBy(...).limit(k)``, which Spark
plans as TakeOrderedAndProject (a bounded heap per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.text import excerpt
from kiln.operators.filters import METRICS
from kiln.operators.ordering import exact_quantiles


def filter_stats(metrics: DataFrame) -> DataFrame:
    """A1: seen, kept, dropped and the two rates (null on an empty corpus)."""
    agg = metrics.agg(
        F.count("*").alias("seen"),
        F.count_if("passed").alias("kept"),
        F.count_if(~F.col("passed")).alias("dropped"),
    )
    return agg.select(
        "seen",
        "kept",
        "dropped",
        F.try_divide(F.col("kept"), F.col("seen")).alias("keep_rate"),
        F.try_divide(F.col("dropped"), F.col("seen")).alias("drop_rate"),
    )


def drop_reasons(metrics: DataFrame) -> DataFrame:
    """A2: documents failing each reason (a document counts once per reason)."""
    return (
        metrics.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("documents"))
    )


def metric_summary(metrics: DataFrame) -> DataFrame:
    """A3: min, max, mean, median, p95 of each metric over all seen documents."""
    long = metrics.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in METRICS
                ]
            )
        ).alias("m")
    ).select("m.metric", "m.value")
    q = exact_quantiles(long, "metric", "value", [("median", 0.5), ("p95", 0.95)])
    return q.select("metric", "min", "max", "mean", "median", "p95")


def dropped_examples(metrics: DataFrame, k: int = 20, order_col: str = "seq") -> DataFrame:
    """A4: first ``k`` dropped documents in corpus order, reasons and excerpt."""
    return (
        metrics.where(~F.col("passed"))
        .orderBy(order_col)
        .limit(k)
        .select("doc_id", order_col, "reasons", excerpt("text", 300).alias("text"))
    )
