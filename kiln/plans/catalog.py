"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the test tables.

Column names equal those of the SQL in ``kiln.plans.oracle``; doubles are
rounded to 6 places and arrays are joined to text on both sides so that
the two engines hash the same values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.config import IngestConfig
from kiln.config import DedupConfig, PackConfig, TokenizerConfig
from kiln.operators import bpe, dedup, packing, reports, runlog, vocab
from kiln.operators.bands import candidate_probability
from kiln.operators.ordering import with_prefix_sum
from kiln.plans.tables import conformed, documents, kept, metrics, scan_partitions, table
from kiln.session import cut_lineage, drop_stage, stage_table
from kiln.sources import corpus, packed, sinks
from kiln.streaming.ingest import scratch

Query = Callable[[SparkSession, str], DataFrame]
R = 6  # rounding of doubles in query outputs


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R).alias(c)


# ---------------------------------------------------------------- sources
def q_conform_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf)


def q_assign_doc_id(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "doc_id")
    out = corpus.assign_doc_id(raw, prefix="doc", order_col="seq")
    return out.select("seq", "position", "generated_id", F.col("doc_id").cast("string").alias("doc_id"))


def q_take_budget_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return corpus.take_budget(docs, target_tokens=100_000).select("seq", "doc_id", "token_count")


def q_take_budget_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    out = corpus.take_budget(docs, target_tokens=150_000, target_docs=300)
    return out.select("seq", "doc_id", "token_count")


def q_shard_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = corpus.with_shards(documents(spark, sf), shard_size=64)
    return docs.groupBy("shard").agg(
        F.count("*").alias("documents"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.sum("token_count").cast("long").alias("tokens"),
    )


def _written_shards(spark: SparkSession, sf: str) -> str:
    out = scratch(spark, "shards")
    corpus.write_shards(documents(spark, sf), out, shard_size=64)
    return out


def q_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest of written shards; their bytes on disk depend on the writer, so only that they are told is shown."""
    out = _written_shards(spark, sf)
    size = corpus.directory_size(spark, out).first()["bytes"]
    m = corpus.manifest(corpus.scan_shards(spark, out), IngestConfig(shard_size=64), size_bytes=size, output_dir="shards")
    told = (F.col("bytes") > 0) & (F.col("size") == corpus.format_bytes("bytes"))
    return m.withColumn("size_known", told).drop("created_at", "bytes", "size")


def q_shard_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.shard_manifest(spark, _written_shards(spark, sf)).drop("file_group")


def q_text_scan(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.text_scan(spark, _written_shards(spark, sf))


def q_format_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Document lengths scaled so that every unit occurs."""
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * F.pow(F.lit(1024.0), F.col("doc_id") % 6)).alias("n"))
    return docs.select("doc_id", corpus.format_bytes("n").alias("size"))


def q_filtered_shards(spark: SparkSession, sf: str) -> DataFrame:
    """The filter's result written by the shards of its input, and read again."""
    out = scratch(spark, "filtered-shards")
    passed = metrics(spark, sf).where("passed").select("seq", *corpus.DOC_COLUMNS)
    shards = corpus.with_shards(documents(spark, sf).select("seq"), shard_size=64).select("seq", "shard")
    corpus.write_shards(passed.join(shards, "seq"), out, shard_size=64)
    return corpus.scan_shards(spark, out).select("shard", "seq", "doc_id", "token_count")


# ---------------------------------------------------------------- filters
def q_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(spark, sf).select("seq", "char_length", F.col("passed_too_short").alias("passed"))


def q_symbol_ratio(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics(spark, sf)
    return m.select("seq", _r("symbol_ratio"), F.col("passed_high_symbol_ratio").alias("passed"))


def q_repeated_chars(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics(spark, sf)
    return m.select("seq", "longest_repeat", F.col("passed_repeated_chars").alias("passed"))


def q_repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics(spark, sf)
    return m.select("seq", _r("repeated_lines"), F.col("passed_repeated_lines").alias("passed"))


def q_token_count_filter(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics(spark, sf)
    return m.select("seq", "token_count", F.col("passed_token_count").alias("passed"))


def q_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf).select("seq", "doc_id", "token_count", "text")


def q_fail_reasons(spark: SparkSession, sf: str) -> DataFrame:
    m = metrics(spark, sf).where(~F.col("passed"))
    return m.select("seq", F.array_join("reasons", ",").alias("reasons"))


def q_filter_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = reports.filter_stats(metrics(spark, sf))
    return s.select("seen", "kept", "dropped", _r("keep_rate"), _r("drop_rate"))


def q_drop_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return reports.drop_reasons(metrics(spark, sf))


def q_metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = reports.metric_summary(metrics(spark, sf))
    return s.select("metric", *[_r(c) for c in ("min", "max", "mean", "median", "p95")])


def q_dropped_examples(spark: SparkSession, sf: str) -> DataFrame:
    ex = reports.dropped_examples(metrics(spark, sf))
    return ex.select("seq", "doc_id", F.array_join("reasons", ",").alias("reasons"), "text")


# ---------------------------------------------------------------- dedup
DCFG = DedupConfig()


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered documents as a written stage: the filter runs once, later reads are pruned."""
    return stage_table(kept(spark, sf), "filtered")


def _firsts(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered, exact-deduplicated documents as a written stage."""
    return stage_table(dedup.exact_dedup(_kept(spark, sf)), "firsts")


def q_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_dedup(_kept(spark, sf)).select("seq", "doc_id")


def q_shingles(spark: SparkSession, sf: str) -> DataFrame:
    d = dedup.with_shingle_hashes(documents(spark, sf).select("seq", "text"), DCFG.shingle_size, "text", "h")
    return d.select(
        "seq",
        F.size("h").alias("n_shingles"),
        F.aggregate("h", F.lit(0).cast("long"), lambda acc, x: acc + x % F.lit(1 << 32)).alias("hash_sum"),
    )


def q_minhash(spark: SparkSession, sf: str) -> DataFrame:
    signed = dedup.with_signatures(documents(spark, sf).select("seq", "text"), DCFG)
    return signed.select("seq", F.array_join(F.transform("signature", lambda v: v.cast("string")), ",").alias("signature"))


def q_lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    signed = dedup.with_signatures(_firsts(spark, sf).select("seq", "text"), DCFG)
    return dedup.first_partner(dedup.band_membership(signed, DCFG))


def q_candidate_probability(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's first partner with their similarity, and how probable the best bands make such a candidate."""
    firsts = _firsts(spark, sf).select("seq", "text")
    partners = cut_lineage(dedup.first_partner(dedup.band_membership(dedup.with_signatures(firsts, DCFG), DCFG)))
    ends = partners.select("seq").union(partners.select("first_match")).distinct()
    sets = dedup.shingle_sets(firsts.join(ends, "seq", "left_semi"), DCFG)
    near = dedup.similar(partners.select(F.col("first_match").alias("lo"), F.col("seq").alias("hi")), sets, 0.0)
    told = near.withColumn("probability", candidate_probability(F.col("jaccard"), DCFG.bands, DCFG.rows))
    return told.select("lo", "hi", F.lit(DCFG.bands).alias("bands"), F.lit(DCFG.rows).alias("rows"), _r("jaccard"), _r("probability"))


def q_verified_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = dedup.verified_pairs(_firsts(spark, sf).select("seq", "text"), DCFG)
    return pairs.select("lo", "hi", _r("jaccard"))


def q_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    result, _ = dedup.near_dedup(_kept(spark, sf), DCFG)
    return result.select("seq", "doc_id", "kept")


def q_verified_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    result, _ = dedup.verified_near_dedup(_kept(spark, sf), DCFG)
    return result.select("seq", "doc_id", "kept")


def q_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    result, _ = dedup.near_dedup(_kept(spark, sf), DCFG)
    return dedup.dedup_stats(result).select("seen", "kept", "removed", "removed_tokens", _r("duplicate_rate"))


def q_dup_examples(spark: SparkSession, sf: str) -> DataFrame:
    result, membership = dedup.near_dedup(_kept(spark, sf), DCFG)
    ex = dedup.dup_examples(result, membership)
    return ex.select("seq", "removed_doc", F.array_join("matched_docs", ",").alias("matched_docs"), "cluster_size")


# ---------------------------------------------------------------- packing
PCFG = PackConfig()
STEPS, BATCH = 50, 8


def _ints(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)


def _word_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Exact-deduplicated kept documents with word-level ids, as a written stage.

    All kept texts are coded as they are filtered, so no text is written, and
    copies are told by the hash of the text.  Copies have no words of their
    own: the vocabulary is that of the first ones (a row without a key is none).
    """
    blocks = vocab.word_blocks(kept(spark, sf).where("seq is not null").select("seq", "text"))
    firsts = dedup.exact_dedup(blocks.where("words is null").select("seq", "text_hash"), "text_hash")
    ids = vocab.word_ids(firsts, blocks, vocab.word_vocab(blocks))
    drop_stage(blocks)
    return ids


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    blocks, _, _ = packing.pack_blocks(_word_docs(spark, sf), PCFG)
    return blocks


def q_prefix_sum(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("seq", (F.col("token_count") + 1).alias("n"))
    out, _ = with_prefix_sum(docs, "seq", "n", "cum_before")
    return out.select("seq", "n", "cum_before")


REPORT_DOUBLES = ("utilization_percent", "pad_percentage", "avg_tokens_per_doc", "avg_tokens_per_block")


def q_packed_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Packed blocks written by split in several files, read back with the length check."""
    out = scratch(spark, "packed")
    sinks.write_packed(_blocks(spark, sf), out, files=4)
    return sinks.read_packed(spark, out).select("split", "block", "n_real", F.size("input_ids").alias("n_ids"))


def q_packed_blocks(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return b.select("split", "block", "n_real", _ints("input_ids"), _ints("labels"), _ints("loss_mask"))


def q_packing_report(spark: SparkSession, sf: str) -> DataFrame:
    docs = _word_docs(spark, sf)
    blocks, _, _ = packing.pack_blocks(docs, PCFG)
    size = vocab.N_SPECIAL + docs.select(F.explode("ids").alias("id")).agg(F.countDistinct("id")).first()[0]
    rep = packing.packing_report(docs.count(), blocks, PCFG, vocab_size=size)
    return rep.select(*[_r(c) if c in REPORT_DOUBLES else c for c in rep.columns])


def _packed(spark: SparkSession, sf: str) -> str:
    """The blocks written in the packed format."""
    out = scratch(spark, "packed-blocks")
    docs = _word_docs(spark, sf)
    packed.write_blocks(packing.pack_blocks(docs, PCFG)[0], out, PCFG.block_size, files=4, ranged=True)
    drop_stage(docs)
    return out


def q_packed_source(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks written in the packed format and read again by block range."""
    b = packed.read_blocks(spark, _packed(spark, sf), per_partition=16)
    return b.select("split", "block", "n_real", _ints("input_ids"), _ints("labels"), _ints("loss_mask"))


def _plan(spark: SparkSession, sf: str) -> DataFrame:
    """Draws over the written blocks, whose arrays are read by offset."""
    path = _packed(spark, sf)
    return packed.lookup(packing.batch_draws(spark, STEPS, BATCH, packed.block_count(path, "train"), seed=0), path)


def q_batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf).select("step", "slot", "block", "n_real")


def q_batch_contract(spark: SparkSession, sf: str) -> DataFrame:
    return packing.batch_contract(_plan(spark, sf), PCFG.block_size, accumulation=4)


# ---------------------------------------------------------------- tokenizer
TCFG = TokenizerConfig()
#: A vocabulary of the first merges, which a recursive query learns as well.
FEW = TokenizerConfig(vocab_size=300)
SHARD = 64


def _split_docs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, held-out) documents by whole shards, one written stage for both sides."""
    split = bpe.heldout_split(_firsts(spark, sf).select("seq", "text"), shard_size=SHARD, heldout=TCFG.heldout_split)
    split = stage_table(split.select("seq", "text", "heldout"), "tokenizer-split")
    return split.where("not heldout").select("seq", "text"), split.where("heldout").select("seq", "text")


_MODELS: dict[tuple, bpe.BPEModel] = {}


def _model(train: DataFrame, cfg: TokenizerConfig) -> bpe.BPEModel:
    """The tokenizer of these very documents: kept by their content, so a changed input is trained anew."""
    told = train.agg(F.count("*").alias("n"), F.sum(F.xxhash64("seq", "text").cast("decimal(38,0)")).alias("s")).first()
    key = (cfg, told.n, told.s)
    if key not in _MODELS:
        _MODELS[key] = bpe.train_bpe(train, cfg)
    return _MODELS[key]


def q_heldout_split(spark: SparkSession, sf: str) -> DataFrame:
    out = bpe.heldout_split(documents(spark, sf).select("seq"), shard_size=SHARD, heldout=TCFG.heldout_split)
    return out.select("seq", "shard", "heldout")


def q_pretoken_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.pretoken_counts(_firsts(spark, sf).select("seq", "text"))


def q_bpe_vocab(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    return _model(_split_docs(spark, sf)[0], cfg).vocab_frame(spark).select("id", "token")


def q_bpe_merges(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    return _model(_split_docs(spark, sf)[0], cfg).merges_frame(spark)


def q_bpe_encode(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    train, held = _split_docs(spark, sf)
    enc = bpe.encode_documents(train.unionByName(held), _model(train, cfg))
    return enc.select("seq", F.size("ids").alias("n_tokens"), _ints("ids"))


def q_bpe_decode(spark: SparkSession, sf: str) -> DataFrame:
    train, held = _split_docs(spark, sf)
    model = _model(train, TCFG)
    return bpe.decode_documents(bpe.encode_documents(train.unionByName(held), model), model)


def q_bpe_contract(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    train, held = _split_docs(spark, sf)
    model = _model(train, cfg)
    encoded = bpe.encode_documents(train.unionByName(held), model)
    return bpe.contract(model.vocab_frame(spark), model.merges_frame(spark), encoded, cfg)


def q_token_counts(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    train, held = _split_docs(spark, sf)
    return bpe.token_counts(train.unionByName(held), _model(train, cfg))


def q_fertility(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    train, held = _split_docs(spark, sf)
    f = bpe.fertility(bpe.fertility_rows(held, bpe.token_counts(held, _model(train, cfg))))
    return f.select("ratio", _r("mean"), _r("median"), _r("p90"), "documents", "total_tokens", "total_words",
                    "total_characters")


def q_worst_fertility(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    train, held = _split_docs(spark, sf)
    model = _model(train, cfg)
    w = bpe.worst_fertility(bpe.fertility_rows(held, bpe.token_counts(held, model)), held, model)
    return w.select("seq", "tokens", "words", "chars", _r("tokens_per_word"), _r("tokens_per_char"), "text", "decoded",
                    F.array_join("token_strings", " ").alias("token_strings"), _ints("ids"))


def _bpe_blocks(spark: SparkSession, sf: str, cfg: TokenizerConfig) -> tuple[DataFrame, DataFrame, bpe.BPEModel]:
    train, held = _split_docs(spark, sf)
    model = _model(train, cfg)
    encoded = stage_table(bpe.encode_documents(train.unionByName(held), model), "bpe-ids")
    return packing.pack_blocks(encoded, PCFG)[0], encoded, model


def q_packed_blocks_bpe(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    """Documents encoded by the trained tokenizer, packed."""
    blocks = _bpe_blocks(spark, sf, cfg)[0]
    return blocks.select("split", "block", "n_real", F.array_max("input_ids").alias("max_id"), _ints("input_ids"))


def q_packing_report_bpe(spark: SparkSession, sf: str, cfg: TokenizerConfig = TCFG) -> DataFrame:
    """The packing report over the tokenizer's ids, each of which must be in its vocabulary."""
    blocks, encoded, model = _bpe_blocks(spark, sf, cfg)
    rep = packing.packing_report(encoded.count(), blocks, PCFG, vocab_size=model.vocab_size)
    return rep.select(*[_r(c) if c in REPORT_DOUBLES else c for c in rep.columns])


def q_nfc_normalize(spark: SparkSession, sf: str) -> DataFrame:
    d = documents(spark, sf).select("seq", "text", bpe.nfc("text").alias("nfc"))
    return d.select("seq", F.length("nfc").alias("n_chars"), (F.col("nfc") != F.col("text")).alias("changed"))


# ---------------------------------------------------------------- streaming
def _doc_stream(spark: SparkSession, sf: str) -> DataFrame:
    from kiln.streaming.ingest import document_stream, table_pattern

    schema = table(spark, sf, "documents").schema
    folder = table_pattern(f"{sf.rstrip('/')}/documents.parquet")
    return conformed(document_stream(spark, folder, schema, spread_to=scan_partitions(spark)))


def q_stream_filter(spark: SparkSession, sf: str) -> DataFrame:
    from kiln.streaming.ingest import run_to_end, start_filter

    out, ck = scratch(spark, "stream-filter"), scratch(spark, "stream-filter-ckpt")
    docs = _doc_stream(spark, sf)
    run_to_end(start_filter(docs, out, ck))
    return spark.read.schema(docs.schema).parquet(out)


def q_stream_totals(spark: SparkSession, sf: str) -> DataFrame:
    from kiln.streaming.ingest import run_to_end, start_totals, totals

    out = scratch(spark, "stream-totals")
    run_to_end(start_totals(_doc_stream(spark, sf), out, scratch(spark, "stream-totals-ckpt")))
    return totals(spark, out)


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered documents up to a token budget, from files that arrive one by one."""
    from kiln.streaming.ingest import document_stream, run_to_end, start_ingest

    src, raw = _arrivals(spark, sf)
    stream = conformed(document_stream(spark, src, raw.schema, max_files_per_trigger=1, spread_to=scan_partitions(spark)))
    out = scratch(spark, "ingest")
    cfg = IngestConfig(target_tokens=60_000)
    run_to_end(start_ingest(stream, out, scratch(spark, "ingest-ledger"), scratch(spark, "ingest-ckpt"), cfg))
    return spark.read.parquet(out).select("seq", "position", "generated_id", "token_count")


def q_stream_budget(spark: SparkSession, sf: str) -> DataFrame:
    """The running totals up to the kept document that crosses a budget."""
    from kiln.streaming.ingest import document_stream, run_to_end, start_totals, totals

    src, raw = _arrivals(spark, sf)
    stream = conformed(document_stream(spark, src, raw.schema, max_files_per_trigger=1, spread_to=scan_partitions(spark)))
    out = scratch(spark, "stream-budget")
    run_to_end(start_totals(stream, out, scratch(spark, "stream-budget-ckpt"), target_tokens=50_000))
    return totals(spark, out)


BATCHES = 3


def _arrivals(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """The documents as files that arrive in corpus order, one per range of doc_id."""
    raw = table(spark, sf, "documents")
    src = scratch(spark, "arrivals")
    low, high = raw.agg(F.min("doc_id"), F.max("doc_id")).first()
    step = ((high or 0) - (low or 0)) // BATCHES + 1
    for i in range(BATCHES):
        part = raw.where((F.col("doc_id") >= (low or 0) + i * step) & (F.col("doc_id") < (low or 0) + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(src)
    return src, raw


def q_stream_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from kiln.operators.filters import quality_filter
    from kiln.streaming.dedup import start_near_dedup
    from kiln.streaming.ingest import document_stream, run_to_end

    src, raw = _arrivals(spark, sf)
    stream = document_stream(spark, src, raw.schema, max_files_per_trigger=1, spread_to=scan_partitions(spark))
    out, index = scratch(spark, "stream-dedup"), scratch(spark, "stream-dedup-index")
    run_to_end(start_near_dedup(quality_filter(conformed(stream)), out, index, scratch(spark, "stream-dedup-ckpt"), DCFG))
    return spark.read.parquet(out).select("seq", "doc_id")


# ---------------------------------------------------------------- run logs, reports
def _log(spark: SparkSession, sf: str) -> DataFrame:
    """A run log from ``events``: a run per user, a record per event."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run"),
        F.col("event_id").alias("step"),
        (F.col("value") + 1).alias("train_loss"),
        F.col("value").alias("val_loss"),
    )


def _read_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log appended as JSON lines, a folder per run, and read again."""
    out = scratch(spark, "run-log")
    runlog.append_log(_log(spark, sf).withColumn("run", F.pmod(F.col("run").cast("long"), F.lit(20)).cast("string")), out)
    return runlog.read_log(spark, out)


def q_run_log(spark: SparkSession, sf: str) -> DataFrame:
    return _read_log(spark, sf).select("run", "step", _r("train_loss"), _r("val_loss"))


def q_loss_curves(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.loss_curves(_log(spark, sf)).select("run", "step", _r("train_loss"), _r("val_loss"))


def q_run_best(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.running_best(_log(spark, sf)).select("run", "step", "improved", _r("best_so_far"))


def q_run_throughput(spark: SparkSession, sf: str) -> DataFrame:
    timed = _log(spark, sf).withColumn("step_time", 1 + F.col("step") % 7)
    out = runlog.throughput(timed, runlog.tokens_per_step(BATCH, PCFG.block_size, 4))
    return out.select("run", "step", _r("tokens_per_second"))


def q_eval_steps(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.eval_steps(_log(spark, sf), 100).select("run", "step", _r("val_loss"))


def q_json_report(spark: SparkSession, sf: str) -> DataFrame:
    """The drop-reason report written as JSON and read again."""
    out = scratch(spark, "report")
    sinks.write_report(reports.drop_reasons(metrics(spark, sf)), out)
    return spark.read.schema("reason string, documents bigint").json(out)


QUERIES: dict[str, Query] = {
    "conform_documents": q_conform_documents,
    "assign_doc_id": q_assign_doc_id,
    "take_budget_tokens": q_take_budget_tokens,
    "take_budget_docs": q_take_budget_docs,
    "shard_counts": q_shard_counts,
    "manifest": q_manifest,
    "shard_manifest": q_shard_manifest,
    "text_scan": q_text_scan,
    "format_bytes": q_format_bytes,
    "filtered_shards": q_filtered_shards,
    "length_filter": q_length_filter,
    "symbol_ratio": q_symbol_ratio,
    "repeated_chars": q_repeated_chars,
    "repeated_lines": q_repeated_lines,
    "token_count_filter": q_token_count_filter,
    "quality_filter": q_quality_filter,
    "fail_reasons": q_fail_reasons,
    "filter_stats": q_filter_stats,
    "drop_reasons": q_drop_reasons,
    "metric_summary": q_metric_summary,
    "dropped_examples": q_dropped_examples,
    "exact_dedup": q_exact_dedup,
    "shingles": q_shingles,
    "minhash": q_minhash,
    "lsh_candidates": q_lsh_candidates,
    "candidate_probability": q_candidate_probability,
    "verified_pairs": q_verified_pairs,
    "near_dedup": q_near_dedup,
    "verified_near_dedup": q_verified_near_dedup,
    "dedup_stats": q_dedup_stats,
    "dup_examples": q_dup_examples,
    "prefix_sum": q_prefix_sum,
    "packed_blocks": q_packed_blocks,
    "packed_sink": q_packed_sink,
    "packed_source": q_packed_source,
    "packed_blocks_bpe": q_packed_blocks_bpe,
    "packing_report": q_packing_report,
    "batch_plan": q_batch_plan,
    "batch_contract": q_batch_contract,
    "heldout_split": q_heldout_split,
    "pretoken_counts": q_pretoken_counts,
    "bpe_vocab": q_bpe_vocab,
    "bpe_merges": q_bpe_merges,
    "bpe_encode": q_bpe_encode,
    "bpe_decode": q_bpe_decode,
    "bpe_contract": q_bpe_contract,
    "fertility": q_fertility,
    "worst_fertility": q_worst_fertility,
    "token_counts": q_token_counts,
    "packing_report_bpe": q_packing_report_bpe,
    "nfc_normalize": q_nfc_normalize,
    "stream_filter": q_stream_filter,
    "stream_totals": q_stream_totals,
    "stream_near_dedup": q_stream_near_dedup,
    "stream_ingest": q_stream_ingest,
    "stream_budget": q_stream_budget,
    "run_log": q_run_log,
    "loss_curves": q_loss_curves,
    "run_best": q_run_best,
    "run_throughput": q_run_throughput,
    "eval_steps": q_eval_steps,
    "json_report": q_json_report,
}

# The same over the first merges, with SQL.
_FIRST = (
    "bpe_vocab", "bpe_merges", "bpe_encode", "bpe_contract", "fertility", "worst_fertility", "token_counts",
    "packed_blocks_bpe", "packing_report_bpe",
)
QUERIES |= {f"{name}_first_merges": functools.partial(QUERIES[name], cfg=FEW) for name in _FIRST}
