"""The quality filter, running totals, and numbering up to a budget over a file stream.

F1-F7 are stateless per document, so the batch plan runs unchanged on a
``readStream`` source; the checkpoint folder gives the resume the
reference lacks.  Streams are given in the document schema; outputs go to
file sinks, never to the driver.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kiln.config import FilterConfig, IngestConfig
from kiln.operators.filters import quality_metrics
from kiln.operators.ordering import with_position
from kiln.session import checkpoint_dir
from kiln.sources.corpus import DOC_COLUMNS, take_budget, with_doc_ids


def document_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    spread_to: int | None = None,
) -> DataFrame:
    """S1 streaming form: Parquet files arriving in ``folder``.

    ``glob`` selects files by their own names; a table that is one file or a
    folder of files is read by its path as a pattern (see ``table_pattern``).
    ``spread_to`` round-robins each micro-batch over that many tasks, for
    sources whose files are few and large (one row group is one task).
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(folder)
    return stream.repartition(spread_to) if spread_to else stream


def table_pattern(path: str) -> str:
    """A pattern that only ``path`` matches, be it a file or a folder of files.

    A stream takes a plain path for a folder, and a filter on file names does
    not see the folder's own; what a pattern matches may be either.
    """
    return f"{path[:-1]}[{path[-1]}]"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_batch(df: DataFrame, path: str, batch_id: int, *further: str) -> None:
    """Write a micro-batch under ``batch_id=<n>``; a replay replaces its own partition only."""
    out = df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("batch_id", *further).parquet(path)


def start_filter(docs: DataFrame, out_dir: str, ckpt: str, cfg: FilterConfig = FilterConfig()) -> StreamingQuery:
    """Kept documents of each micro-batch, all ten columns and ``seq``, appended to ``out_dir``."""
    kept = quality_metrics(docs, cfg).where("passed").select("seq", *DOC_COLUMNS)
    return kept.writeStream.format("parquet").option("checkpointLocation", ckpt).start(out_dir)


TOTALS = "seen bigint, kept bigint, kept_tokens bigint, batch_id bigint"


def totals(spark: SparkSession, out_dir: str, before: int | None = None) -> DataFrame:
    """R2 result: one row with the sums over the batches (those before ``before``, if given)."""
    rows = spark.read.schema(TOTALS).parquet(out_dir)
    rows = rows if before is None else rows.where(F.col("batch_id") < before)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("seen", "kept", "kept_tokens")])


def start_totals(
    docs: DataFrame, out_dir: str, ckpt: str, cfg: FilterConfig = FilterConfig(), target_tokens: int | None = None
) -> StreamingQuery:
    """R2: seen / kept / kept tokens per micro-batch, written to ``out_dir``.

    With ``target_tokens`` the totals end with the document that crosses it
    (documents arrive in the order of ``seq``), and the query stops itself.
    """
    docs.sparkSession.createDataFrame([], TOTALS).write.mode("ignore").partitionBy("batch_id").parquet(out_dir)
    m = quality_metrics(docs, cfg).select("seq", "passed", "token_count")
    stop = Stop()

    def handle(batch: DataFrame, batch_id: int) -> None:
        left = None
        if target_tokens is not None:
            left = target_tokens - totals(batch.sparkSession, out_dir, batch_id).first()["kept_tokens"]
            if left <= 0:
                return stop.after(batch_id)
            spent = batch.withColumn("spent", F.when(F.col("passed"), F.col("token_count")).otherwise(0))
            batch = take_budget(spent, target_tokens=left, token_col="spent")
        sums = batch.agg(
            F.count("*").alias("seen"),
            F.count_if("passed").alias("kept"),
            F.coalesce(F.sum(F.when(F.col("passed"), F.col("token_count"))), F.lit(0)).cast("long").alias("kept_tokens"),
        )
        write_batch(sums, out_dir, batch_id)
        if left is not None and totals(batch.sparkSession, out_dir, batch_id + 1).first()["kept_tokens"] >= target_tokens:
            stop.after(batch_id)

    return stop.watch(m.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt).start())


class Stop:
    """Lets a query end itself: once the batch that asked for it is committed, the query is stopped."""

    def __init__(self) -> None:
        self.asked, self.batch_id = threading.Event(), -1

    def after(self, batch_id: int) -> None:
        self.batch_id = batch_id
        self.asked.set()

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        def wait() -> None:
            while query.isActive:
                if self.asked.wait(0.2):
                    last = query.lastProgress
                    if last is not None and last["batchId"] >= self.batch_id:
                        query.stop()
                    else:
                        time.sleep(0.1)

        threading.Thread(target=wait, daemon=True).start()
        return query


LEDGER = "documents bigint, tokens bigint, reached boolean, batch_id bigint"


def ledger(spark: SparkSession, ledger_dir: str, before: int | None = None) -> dict:
    """Documents and tokens taken by the batches (those before ``before``), and whether a budget was reached."""
    rows = spark.read.schema(LEDGER).parquet(ledger_dir)
    rows = rows if before is None else rows.where(F.col("batch_id") < before)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "tokens")]
    return rows.agg(*sums, F.coalesce(F.bool_or("reached"), F.lit(False)).alias("reached")).first().asDict()


def start_ingest(docs: DataFrame, out_dir: str, ledger_dir: str, ckpt: str, cfg: IngestConfig = IngestConfig()) -> StreamingQuery:
    """S3 + S4 on a stream: numbered documents up to a budget, with resume.

    Documents arrive in the order of ``seq``.  Each batch commits to a ledger
    how many documents and tokens it took; a batch numbers its documents from
    the sum over the batches before it, and takes the prefix that the budget
    leaves (the document that crosses it is the last).  A replayed batch finds
    the same sums and writes the same rows again.  When the budget is reached,
    the query stops itself; batches after that read nothing.
    """
    docs.sparkSession.createDataFrame([], LEDGER).write.mode("ignore").partitionBy("batch_id").parquet(ledger_dir)
    stop = Stop()

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        taken = ledger(spark, ledger_dir, batch_id)
        if taken["reached"]:
            return stop.after(batch_id)
        left_tokens = None if cfg.target_tokens is None else cfg.target_tokens - taken["tokens"]
        left_docs = None if cfg.target_docs is None else cfg.target_docs - taken["documents"]
        batch = batch.persist()
        kept = take_budget(batch, target_tokens=left_tokens, target_docs=left_docs)
        numbered = with_position(kept, "seq").withColumn("position", F.col("position") + taken["documents"])
        write_batch(with_doc_ids(numbered, cfg.prefix), out_dir, batch_id)
        sums = spark.read.schema(docs.schema).parquet(f"{out_dir}/batch_id={batch_id}") if batch.limit(1).count() else batch
        sums = sums.agg(F.count("*").alias("documents"), F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("tokens"))
        over = F.lit(False)
        if left_tokens is not None:
            over = over | (F.col("tokens") >= left_tokens)
        if left_docs is not None:
            over = over | (F.col("documents") >= left_docs)
        write_batch(sums.withColumn("reached", over), ledger_dir, batch_id)
        batch.unpersist()
        if ledger(spark, ledger_dir, batch_id + 1)["reached"]:
            stop.after(batch_id)

    return stop.watch(docs.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt).start())


def run_to_end(query: StreamingQuery) -> None:
    """Until all that is there has been handled, or the query has stopped itself; a failed query raises."""
    try:
        query.processAllAvailable()
    except Exception:
        if query.exception() is not None or query.isActive:
            raise
    finally:
        query.stop()
