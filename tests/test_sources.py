import os

from pyspark.sql import functions as F

from kiln.config import IngestConfig, PackConfig
from kiln.operators import packing
from kiln.plans.tables import documents
from kiln.sources import corpus, sinks

from conftest import SF001


def test_take_budget_keeps_the_crossing_document(spark):
    df = spark.createDataFrame([(i, i * 10, 5) for i in range(1, 9)], "seq long, x long, token_count int")
    # 5 tokens each: the budget 15 is hit exactly by the third document, which is kept;
    # 16 is crossed by the fourth, which is kept too.
    assert [r.seq for r in corpus.take_budget(df, target_tokens=15).orderBy("seq").collect()] == [1, 2, 3]
    assert [r.seq for r in corpus.take_budget(df, target_tokens=16).orderBy("seq").collect()] == [1, 2, 3, 4]
    # Both limits: the first one reached stops.
    assert corpus.take_budget(df, target_tokens=100, target_docs=2).count() == 2
    assert corpus.take_budget(df, target_tokens=6, target_docs=5).count() == 2


def test_format_bytes(spark):
    want = {
        0: "0.00 B",
        1023: "1023.00 B",
        1024: "1.00 KB",
        3126374: "2.98 MB",
        5 * 1024**3: "5.00 GB",
        5 * 1024**4: "5.00 TB",
        3 * 1024**5: "3.00 PB",
        4000 * 1024**5: "4000.00 PB",
    }
    df = spark.createDataFrame([(v,) for v in want], "n long")
    assert {r.n: r.s for r in df.select("n", corpus.format_bytes("n").alias("s")).collect()} == want


def test_conform_reads_what_it_wrote_and_renames_nothing_by_itself(spark, tmpdir_fresh):
    raw = spark.createDataFrame([(7, "doc-000000000001", "a b", "src")], "seq long, doc_id string, text string, source string")
    once = corpus.conform(raw)
    row = once.first()
    assert (row.seq, row.doc_id, row.dump, row.token_count) == (7, "doc-000000000001", None, 2)
    path = os.path.join(tmpdir_fresh, "docs")
    once.write.parquet(path)
    again = corpus.conform(corpus.read_corpus(spark, path))
    assert again.schema == once.schema and again.collect() == once.collect()
    assert corpus.conform(raw, renames={"source": "dump"}).first().dump == "src"


def test_manifest_carries_settings_and_place(spark):
    docs = spark.createDataFrame([(0, 3), (0, 4)], "shard int, token_count int")
    row = corpus.manifest(docs, corpus.IngestConfig(shard_size=2), size_bytes=2048, output_dir="out").first()
    assert (row.documents, row.tokens, row.shards, row["size"], row.output_dir) == (2, 7, 1, "2.00 KB", "out")
    assert '"shard_size": 2' in row.config


def test_shards_and_packed_round_trip(spark, tmpdir_fresh):
    df = spark.createDataFrame([(i * 3, f"t{i}") for i in range(25)], "seq long, text string")
    out = os.path.join(tmpdir_fresh, "shards")
    corpus.write_shards(df, out, shard_size=10)
    back = spark.read.parquet(out)
    sizes = {r.shard: r["count"] for r in back.groupBy("shard").count().collect()}
    assert sizes == {0: 10, 1: 10, 2: 5}  # last shard short
    size = corpus.directory_size(spark, out).first().bytes
    assert size > 0

    docs = spark.createDataFrame([(i, [i + 4] * 7) for i in range(9)], "seq long, ids array<int>")
    blocks, _, _ = packing.pack_blocks(docs, PackConfig(block_size=8, train_split=0.9))
    path = os.path.join(tmpdir_fresh, "packed")
    sinks.write_packed(blocks, path, files=3)
    assert sum(f.endswith(".parquet") for f in os.listdir(os.path.join(path, "split=train"))) > 1
    val = sinks.read_packed(spark, path, split="val")
    assert val.count() >= 1
    assert val.where(F.size("input_ids") != 8).count() == 0


def test_shards_are_written_by_range_with_names_and_counts(spark, tmpdir_fresh):
    docs = documents(spark, SF001).repartition(5)
    path = os.path.join(tmpdir_fresh, "shards")
    corpus.write_shards(docs, path, shard_size=16, groups=4)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 4 and not any(f.startswith("shard=") for f in os.listdir(path))
    told = corpus.shard_manifest(spark, path).orderBy("shard").collect()
    n = docs.count()
    assert [(r.shard, r.name, r.documents) for r in told] == [(i, f"shard-{i:05d}", min(16, n - 16 * i)) for i in range(-(-n // 16))]
    assert [r.file_group for r in told] == sorted(r.file_group for r in told)  # a file is a range of shards
    back = corpus.scan_shards(spark, path).withColumn("file", F.input_file_name())
    assert back.groupBy("shard").agg(F.countDistinct("file").alias("n")).where("n <> 1").count() == 0
    assert sorted(r.seq for r in corpus.scan_shards(spark, path, [2, 3]).collect()) == sorted(r.seq for r in back.where("shard in (2, 3)").collect())
    # a filter keeps shards and names
    kept = os.path.join(tmpdir_fresh, "kept")
    corpus.write_shards(corpus.scan_shards(spark, path).where("seq % 3 = 0 and shard <> 2"), kept, shard_size=16)
    names = {r.shard: r.name for r in corpus.shard_manifest(spark, kept).collect()}
    assert names == {r.shard: r.name for r in told if r.shard != 2}
    texts = corpus.text_scan(spark, path)
    assert texts.columns == ["shard", "seq", "text"] and "doc_id" not in texts._jdf.queryExecution().executedPlan().toString()


def test_manifest_counts_the_bytes_on_disk(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "shards")
    corpus.write_shards(documents(spark, SF001), path, shard_size=50)
    size = corpus.directory_size(spark, path).first()["bytes"]
    assert size == sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))
    told = corpus.manifest(corpus.scan_shards(spark, path), IngestConfig(shard_size=50), size_bytes=size).first()
    assert told.bytes == size and told.shards == 4


def test_an_empty_corpus_has_no_shard(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "none")
    corpus.write_shards(documents(spark, SF001).limit(0), path, shard_size=50)
    assert corpus.scan_shards(spark, path).count() == 0 and corpus.shard_manifest(spark, path).count() == 0
