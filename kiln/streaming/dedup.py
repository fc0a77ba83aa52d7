"""Keep-first near-dedup across micro-batches, on keyed state.

The kept document of every band bucket lives in a state store, keyed by
bucket.  A second query owns it: a streaming minimum over two file streams,
the buckets that batches *ask* for and those that batches *kept*.  In update
mode it answers for exactly the buckets that a micro-batch touches, so a
batch's work follows its own buckets and those kept just before, however
many documents came earlier; no index is scanned.

Each micro-batch (documents arrive in corpus order) is handled in
``foreachBatch``: its buckets are written under ``asked``, the second query
runs until it has answered them, documents that share a bucket with an
earlier kept one are removed, keep-first (D4) runs on the rest, and the
batch's kept buckets and documents are written under ``batch_id=<n>`` with
dynamic partition overwrite.

A batch that is replayed after a crash at any point decides the same and
rewrites the same partitions: what it asked for is not written twice, and a
kept document never hits itself or an earlier one, so it does not matter that
the store may know the batch already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kiln.config import DedupConfig
from kiln.operators.dedup import keep_first, lsh_membership
from kiln.streaming.ingest import write_batch

BUCKETS = T.StructType(
    [
        T.StructField(
            "bucket",
            T.StructType([T.StructField("band", T.IntegerType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType())]),
        ),
        T.StructField("seq", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
ANSWERS = T.StructType([BUCKETS["bucket"], T.StructField("kept", T.LongType()), T.StructField("batch_id", T.LongType()), T.StructField("run", T.LongType())])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_batch(batch: DataFrame, first_seqs: DataFrame, membership: DataFrame, answers: DataFrame):
    """``(kept documents, their buckets)`` of one batch; ``answers``: (bucket, kept), the first kept document of each bucket."""
    earlier = F.col("kept") < F.col("seq")
    hit = membership.join(answers.where("kept is not null"), "bucket").where(earlier).select("seq").distinct()
    live = membership.join(hit, "seq", "left_anti")
    removed = keep_first(live, "seq").unionByName(hit)
    kept_seq = first_seqs.join(removed, "seq", "left_anti")
    return batch.join(kept_seq, "seq", "left_semi"), membership.join(kept_seq, "seq", "left_semi").select("bucket", "seq")


def _store_session(spark: SparkSession) -> SparkSession:
    """A session whose state stores keep their rows on disk, not in the executors' heap."""
    side = spark.newSession()
    side.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    side.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return side


def answer(spark: SparkSession, index_dir: str, batch_id: int) -> None:
    """Bring the store up to date and write what it knows of the buckets that were touched."""
    side = _store_session(spark)
    read = lambda name: side.readStream.schema(BUCKETS).parquet(f"{index_dir}/{name}")
    asked = read("asked").select("bucket", F.lit(None).cast("long").alias("kept"))
    kept = read("kept").select("bucket", F.col("seq").alias("kept"))
    first = asked.unionByName(kept).groupBy("bucket").agg(F.min("kept").alias("kept"))

    def told(rows: DataFrame, run: int) -> None:
        write_batch(rows.withColumn("run", F.lit(run).cast("long")), f"{index_dir}/answers", batch_id, "run")

    query = first.writeStream.outputMode("update").foreachBatch(told).option("checkpointLocation", f"{index_dir}/store").trigger(availableNow=True)
    query.start().awaitTermination()


def start_near_dedup(
    stream: DataFrame,
    out_dir: str,
    index_dir: str,
    ckpt: str,
    cfg: DedupConfig = DedupConfig(),
) -> StreamingQuery:
    """Kept documents appended to ``out_dir``; ``index_dir`` holds the store and what is exchanged with it."""
    # The folders exist from the start, so that a missing one later is an error.
    for name, schema in (("asked", BUCKETS), ("kept", BUCKETS), ("answers", ANSWERS)):
        further = [c for c in ("batch_id", "run") if c in schema.names]
        stream.sparkSession.createDataFrame([], schema).write.mode("ignore").partitionBy(*further).parquet(f"{index_dir}/{name}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        first_seqs, membership = lsh_membership(batch, cfg)
        asked = spark.read.schema(BUCKETS).parquet(f"{index_dir}/asked").where(F.col("batch_id") == batch_id)
        if not asked.limit(1).count():  # a replay asks for the same; the store may be reading these files
            write_batch(membership.select("bucket", "seq"), f"{index_dir}/asked", batch_id)
        answer(spark, index_dir, batch_id)
        answers = spark.read.schema(ANSWERS).parquet(f"{index_dir}/answers").where(F.col("batch_id") == batch_id)
        answers = answers.groupBy("bucket").agg(F.min("kept").alias("kept"))
        kept_docs, kept_buckets = dedup_batch(batch, first_seqs, membership, answers)
        write_batch(kept_buckets, f"{index_dir}/kept", batch_id)
        write_batch(kept_docs, out_dir, batch_id)
        batch.unpersist()

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt).start()
