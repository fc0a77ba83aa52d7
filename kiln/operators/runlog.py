"""Run-log analytics L1-L4 over JSONL evaluation records.

Records carry ``step, train_loss, val_loss, learning_rate, grad_norm,
best_val_loss, peak_memory_mb (nullable), tokens_per_second``.  Windows are
partitioned by run, so one task holds one run's evaluations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of one log record.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("train_loss", T.DoubleType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("grad_norm", T.DoubleType()),
        T.StructField("best_val_loss", T.DoubleType()),
        T.StructField("peak_memory_mb", T.DoubleType()),
        T.StructField("tokens_per_second", T.DoubleType()),
    ]
)


def read_log(spark: SparkSession, path: str, with_run: bool = True) -> DataFrame:
    """S14 source: JSONL records; ``run`` is the folder holding the file."""
    df = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(path)
    if with_run:
        df = df.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"(?:run=)?([^/]+)/[^/]+$", 1))
    return df


def append_log(df: DataFrame, path: str) -> None:
    """S14 sink: append records as JSON lines."""
    fields = [f.name for f in LOG_SCHEMA.fields if f.name in df.columns]
    runs = [c for c in ("run",) if c in df.columns]
    writer = df.select(*runs, *fields).write.mode("append")
    (writer.partitionBy("run") if runs else writer).json(path)  # a folder per run


def loss_curves(log: DataFrame) -> DataFrame:
    """L1: step, train and val loss."""
    return log.select(*[c for c in ("run",) if c in log.columns], "step", "train_loss", "val_loss")


def running_best(log: DataFrame, run_col: str = "run") -> DataFrame:
    """L2: best validation loss before each evaluation of a run and whether it improved.

    Strict improvement over every earlier evaluation, starting from +inf;
    ``best_so_far`` includes the current row, as the logger writes it.
    """
    w = Window.partitionBy(run_col).orderBy("step")
    before = F.min("val_loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    prior = F.coalesce(before, F.lit(float("inf")))
    return log.select(
        "*",
        prior.alias("best_before"),
        (F.col("val_loss") < prior).alias("improved"),
        F.least(F.col("val_loss"), prior).alias("best_so_far"),
    )


def throughput(log: DataFrame, tokens_per_step: int, step_time_col: str = "step_time") -> DataFrame:
    """L3: tokens per second = tokens per step / step time."""
    return log.withColumn("tokens_per_second", F.try_divide(F.lit(tokens_per_step).cast("double"), F.col(step_time_col)))


def eval_steps(log: DataFrame, every: int) -> DataFrame:
    """L4: the evaluations at every ``every``-th step."""
    return log.where(F.col("step") % every == 0)


def tokens_per_step(batch_size: int, block_size: int, accumulation: int) -> int:
    """Token budget of one optimizer step."""
    return batch_size * block_size * accumulation
