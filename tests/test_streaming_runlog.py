import json
import os

import pytest
from pyspark.sql import functions as F

from kiln.config import DedupConfig, IngestConfig
from kiln.operators import dedup, runlog
from kiln.operators.filters import quality_filter
from kiln.plans.catalog import QUERIES
from kiln.plans.tables import conformed, documents
from kiln.sources import corpus
from kiln.streaming import dedup as stream_dedup
from kiln.streaming import ingest
from kiln.streaming.dedup import start_near_dedup
from kiln.streaming.ingest import document_stream, run_to_end, start_totals, totals

from conftest import SF001


def test_stream_dedup_over_several_batches_equals_batch(spark, tmpdir_fresh):
    raw = spark.read.parquet(f"{SF001}/documents.parquet")
    src = os.path.join(tmpdir_fresh, "src")
    # Arrival in corpus order: one file per range of doc_id, one file per trigger.
    bounds = list(raw.selectExpr("percentile(doc_id, array(0.33, 0.66))").first()[0])
    edges = [-1, int(bounds[0]), int(bounds[1]), 1 << 62]
    for i in range(3):
        part = raw.where((F.col("doc_id") > edges[i]) & (F.col("doc_id") <= edges[i + 1]))
        part.coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
        os.utime(os.path.join(src, f"part{i}"), (1000 + i, 1000 + i))
    files = []
    for i in range(3):
        d = os.path.join(src, f"part{i}")
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        dst = os.path.join(src, f"batch{i}.parquet")
        os.link(os.path.join(d, f), dst)
        os.utime(dst, (2000 + i, 2000 + i))
        files.append(dst)
    stream = document_stream(spark, src, raw.schema, glob="batch*.parquet", max_files_per_trigger=1)
    kept_stream = quality_filter(conformed(stream))
    out, index = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "index")
    run_to_end(start_near_dedup(kept_stream, out, index, os.path.join(tmpdir_fresh, "ck"), DedupConfig()))
    got = {r.seq for r in spark.read.parquet(out).select("seq").collect()}
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3
    batch_res, _ = dedup.near_dedup(quality_filter(documents(spark, SF001)), DedupConfig())
    assert got == {r.seq for r in batch_res.where("kept").collect()}
    # the store answers for the buckets of a batch and for those kept just before, not for all there are
    count = lambda name: {r.batch_id: r.n for r in spark.read.parquet(f"{index}/{name}").groupBy("batch_id").agg(F.countDistinct("bucket").alias("n")).collect()}
    asked, kept, answers = count("asked"), count("kept"), count("answers")
    assert all(asked[i] <= answers[i] <= asked[i] + kept.get(i - 1, 0) for i in range(3))
    assert answers[2] < kept[0] + kept[1] + asked[2]


def _parts(raw, src, n):
    edges = sorted(r.doc_id for r in raw.select("doc_id").collect())
    step = -(-len(edges) // n)
    for i in range(0, len(edges), step):
        part = raw.where(F.col("doc_id").isin(edges[i : i + step]))
        part.coalesce(1).write.mode("append").parquet(src)


@pytest.mark.parametrize("where", ["asked", "answers", "kept", "out"])
def test_a_replayed_batch_decides_the_same(spark, tmpdir_fresh, monkeypatch, where):
    """A crash before one of the writes of a batch, then the batch again."""
    raw = spark.read.parquet(f"{SF001}/documents.parquet")
    src, out, index, ck = (os.path.join(tmpdir_fresh, x) for x in ("src", "out", "index", "ck"))
    _parts(raw, src, 2)
    stream = quality_filter(conformed(document_stream(spark, src, raw.schema, max_files_per_trigger=1)))
    write, calls = stream_dedup.write_batch, []

    def crash_once(df, path, batch_id, *further):
        name = os.path.basename(path)
        calls.append((name, batch_id))
        if name == where and batch_id == 1 and calls.count((where, 1)) == 1:
            raise RuntimeError("crash between the writes")
        write(df, path, batch_id, *further)

    monkeypatch.setattr(stream_dedup, "write_batch", crash_once)
    with pytest.raises(Exception):
        run_to_end(start_near_dedup(stream, out, index, ck, DedupConfig()))
    run_to_end(start_near_dedup(stream, out, index, ck, DedupConfig()))
    got = {r.seq for r in spark.read.parquet(out).select("seq").collect()}
    batch_res, _ = dedup.near_dedup(quality_filter(documents(spark, SF001)), DedupConfig())
    assert got == {r.seq for r in batch_res.where("kept").collect()}


def test_totals_stop_at_the_budget(spark, tmpdir_fresh):
    raw = spark.read.parquet(f"{SF001}/documents.parquet")
    src = os.path.join(tmpdir_fresh, "src")
    _parts(raw, src, 4)
    stream = conformed(document_stream(spark, src, raw.schema, max_files_per_trigger=1))
    found = {}
    for name, target in (("all", None), ("some", 1)):
        out = os.path.join(tmpdir_fresh, name)
        run_to_end(start_totals(stream, out, os.path.join(tmpdir_fresh, name + "-ck"), target_tokens=target))
        found[name] = totals(spark, out).first()
    assert found["all"].seen == raw.count()
    assert 0 < found["some"].seen < found["all"].seen and found["some"].kept == 1  # up to the document that crosses


def _ingest(spark, tmp, name, cfg, parts=6, src=None):
    raw = spark.read.parquet(f"{SF001}/documents.parquet")
    if src is None:
        src = os.path.join(tmp, name + "-src")
        _parts(raw, src, parts)
    stream = conformed(document_stream(spark, src, raw.schema, max_files_per_trigger=1))
    out, led, ck = (os.path.join(tmp, name + x) for x in ("-out", "-ledger", "-ck"))
    return src, out, led, lambda: ingest.run_to_end(ingest.start_ingest(stream, out, led, ck, cfg))


def test_stream_ingest_equals_the_batch_budget_and_stops(spark, tmpdir_fresh):
    docs = documents(spark, SF001)
    for name, cfg in (("tokens", IngestConfig(target_tokens=30_000)), ("docs", IngestConfig(target_docs=77)), ("both", IngestConfig(target_tokens=30_000, target_docs=20)), ("all", IngestConfig())):
        _, out, led, run = _ingest(spark, tmpdir_fresh, name, cfg)
        run()
        taken = corpus.take_budget(docs, target_tokens=cfg.target_tokens, target_docs=cfg.target_docs)
        want = sorted((r.seq, r.position, f"doc-{r.position:012d}") for r in corpus.assign_doc_id(taken, prefix="doc").collect())
        assert sorted((r.seq, r.position, r.generated_id) for r in spark.read.parquet(out).collect()) == want
        batches = {r.batch_id: r for r in spark.read.parquet(led).collect()}
        assert sum(r.documents for r in batches.values()) == len(want)
        if name != "all":  # nothing after the crossing batch was read
            assert [i for i, r in batches.items() if r.reached] == [max(batches)] and len(batches) < 6


@pytest.mark.parametrize("where", ["out", "ledger"])
def test_a_crash_in_the_crossing_batch_changes_nothing(spark, tmpdir_fresh, monkeypatch, where):
    cfg = IngestConfig(target_tokens=30_000)
    _, whole, _, run = _ingest(spark, tmpdir_fresh, "whole", cfg)
    run()
    crossing = spark.read.parquet(whole).agg(F.max("batch_id")).first()[0]
    _, out, led, run = _ingest(spark, tmpdir_fresh, "again", cfg)
    write, calls = ingest.write_batch, []

    def crash_once(df, path, batch_id, *further):
        calls.append((path, batch_id))
        if path == (out if where == "out" else led) and batch_id == crossing and calls.count((path, batch_id)) == 1:
            raise RuntimeError("crash")
        write(df, path, batch_id, *further)

    monkeypatch.setattr(ingest, "write_batch", crash_once)
    with pytest.raises(Exception):
        run()
    run()
    rows = lambda p: sorted((r.seq, r.position, r.generated_id, r.batch_id) for r in spark.read.parquet(p).collect())
    assert rows(out) == rows(whole)


def test_run_log(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "runA")
    os.makedirs(path)
    vals = [(0, 9.0), (100, 8.0), (200, 8.5), (300, 7.0), (400, 7.0)]
    with open(os.path.join(path, "log.jsonl"), "w") as f:
        for step, v in vals:
            f.write(json.dumps({"step": step, "train_loss": v + 0.1, "val_loss": v, "learning_rate": 1e-3,
                                "grad_norm": 1.0, "best_val_loss": v, "peak_memory_mb": None,
                                "tokens_per_second": 1.0}) + "\n")
    log = runlog.read_log(spark, path)
    best = runlog.running_best(log).orderBy("step").collect()
    assert [r.improved for r in best] == [True, True, False, True, False]
    assert [r.best_so_far for r in best] == [9.0, 8.0, 8.0, 7.0, 7.0]
    assert {r.run for r in best} == {"runA"}
    assert [r.step for r in runlog.eval_steps(log, 200).orderBy("step").collect()] == [0, 200, 400]
    assert runlog.tokens_per_step(8, 1024, 4) == 32768
    tp = runlog.throughput(log.withColumn("step_time", F.lit(2.0)), 32768).first()
    assert tp.tokens_per_second == 16384.0


@pytest.mark.parametrize("files", [0, 1, 3])
def test_streams_read_a_table_that_is_a_folder(spark, tmpdir_fresh, files):
    raw = spark.read.parquet(f"{SF001}/documents.parquet").limit(60)
    raw = raw if files else raw.where("doc_id is null and doc_id is not null")
    raw.repartition(max(1, files)).write.parquet(os.path.join(tmpdir_fresh, "documents.parquet"))
    want = sorted(r.seq for r in quality_filter(documents(spark, tmpdir_fresh)).collect())
    assert sorted(r.seq for r in QUERIES["stream_filter"](spark, tmpdir_fresh).collect()) == want
    told = QUERIES["stream_totals"](spark, tmpdir_fresh).first()
    assert (told.seen, told.kept) == (raw.count(), len(want)) and (len(want) > 0) == (files > 0)
