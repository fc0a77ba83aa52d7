"""Session helpers: a local session for tests and the checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Spark then deletes the shuffle files of a query as it ends (it makes them anew should a stage be asked for again).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on); ``checkpoint_dir`` takes all intermediate tables."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kiln")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.kiln.scanPartitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    directory).  Only a local-mode session without one gets a scratch
    folder of its own; a cluster session without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative stages")
    scratch = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the queries run within are deleted as each ends, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage_table(df: DataFrame, what: str, reader: SparkSession | None = None, lean: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it again.

    For stage boundaries that hold texts: columnar, pruned by what reads it,
    and the lineage ends there.  ``reader``: the session that reads it, if
    another one (with settings of its own) is to go on.  ``lean`` is for
    large stages on little disk: zstd, and no shuffle files outlive the write.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if lean:
        with shuffles_removed(spark):
            df.write.option("compression", "zstd").parquet(path)
    else:
        df.write.parquet(path)
    table = (reader or spark).read.schema(df.schema).parquet(path)
    table._stage = path
    return table


def drop_stage(table: DataFrame) -> None:
    """Delete a stage table (as ``stage_table`` returned it) that nothing reads any more."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(table._stage)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
