"""Packing P1-P9 and its report A7.

The corpus token stream is never materialised.  Each document's ids plus
its EOS get a global start offset from the distributed prefix sum (X1);
a document then emits one slice per (split, block) it touches, so the rows
are documents + blocks, not tokens.  Blocks are assembled by a group-by on
``(split, block)``: each group holds at most ``block_size`` tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.config import PackConfig
from kiln.operators.ordering import with_prefix_sum


def with_eos(ids: Column | str, eos_id: int) -> Column:
    """Append EOS (no BOS)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.concat(c, F.array(F.lit(eos_id)))


def split_cut(total_tokens: int, train_split: float) -> int:
    """``int(N * train_split)`` tokens go to train (may cut a document)."""
    return int(total_tokens * train_split)


def document_slices(
    docs: DataFrame,
    cfg: PackConfig = PackConfig(),
    ids_col: str = "ids",
    order_col: str = "seq",
) -> tuple[DataFrame, int, int]:
    """``(split, block, pos, piece)`` rows, the token total and the cut."""
    toks = docs.select(order_col, with_eos(ids_col, cfg.eos_id).alias("toks"))
    toks = toks.withColumn("n", F.size("toks"))
    placed, total = with_prefix_sum(toks, order_col, "n", "start")
    cut = split_cut(total, cfg.train_split)
    s = cfg.block_size
    start, end = F.col("start"), F.col("start") + F.col("n")
    parts = F.array(
        F.struct(F.lit("train").alias("split"), F.lit(0).cast("long").alias("base"),
                 start.alias("lo"), F.least(end, F.lit(cut)).alias("hi")),
        F.struct(F.lit("val").alias("split"), F.lit(cut).cast("long").alias("base"),
                 F.greatest(start, F.lit(cut)).alias("lo"), end.alias("hi")),
    )
    per_split = placed.select("toks", "start", F.inline(parts)).where(F.col("lo") < F.col("hi"))
    first_b = F.floor((F.col("lo") - F.col("base")) / s)
    last_b = F.floor((F.col("hi") - 1 - F.col("base")) / s)

    def piece(k: Column) -> Column:
        seg_lo = F.greatest(F.col("lo"), F.col("base") + k * s)
        seg_hi = F.least(F.col("hi"), F.col("base") + (k + 1) * s)
        return F.struct(
            k.alias("block"),
            (seg_lo - F.col("base") - k * s).cast("int").alias("pos"),
            F.slice("toks", (seg_lo - F.col("start") + 1).cast("int"), (seg_hi - seg_lo).cast("int")).alias("piece"),
        )

    slices = per_split.select("split", F.inline(F.transform(F.sequence(first_b, last_b), piece)))
    return slices, total, cut


def pack_blocks(
    docs: DataFrame,
    cfg: PackConfig = PackConfig(),
    ids_col: str = "ids",
    order_col: str = "seq",
) -> tuple[DataFrame, int, int]:
    """``(split, block, n_real, input_ids, labels, loss_mask)``.

    The last block of each split is padded; labels are ``ids[1:] + [pad]``
    inside each block (the last label of a block is pad), and the mask is 1
    on every real position, including the last one.  The pieces are dealt by
    ranges of equal width of (split, block), so that a writer of ranges moves
    nothing again.
    """
    slices, total, cut = document_slices(docs, cfg, ids_col, order_col)
    s = cfg.block_size
    n = split_block_counts(total, cut, s)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.col("block") + F.when(F.col("split") == "val", F.lit(n["train"])).otherwise(F.lit(0))
    part = F.floor(number.cast("long") * F.lit(parts) / F.lit(max(1, sum(n.values())))).cast("int")
    slices = slices.withColumn("_part", part).repartitionById(parts, F.col("_part"))
    blocks = slices.groupBy("_part", "split", "block").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"])
        ).alias("real")
    )
    n_real = F.size("real")
    pad = F.lit(cfg.pad_id).cast("int")
    blocks = blocks.select("split", "block", n_real.alias("n_real"), "real")
    padded = F.concat("real", F.array_repeat(pad, F.lit(s) - F.col("n_real")))
    blocks = blocks.select("split", "block", "n_real", padded.alias("input_ids"))
    labels = F.concat(F.slice("input_ids", 2, s - 1), F.array(pad))
    mask = F.concat(
        F.array_repeat(F.lit(1).cast("tinyint"), F.col("n_real")),
        F.array_repeat(F.lit(0).cast("tinyint"), F.lit(s) - F.col("n_real")),
    )
    return blocks.select("split", "block", "n_real", "input_ids", labels.alias("labels"), mask.alias("loss_mask")), total, cut


def packing_report(
    documents: int,
    blocks: DataFrame,
    cfg: PackConfig = PackConfig(),
    vocab_size: int | None = None,
) -> DataFrame:
    """The packing report from the number of documents and the block table (no token explode)."""
    s = cfg.block_size
    b = blocks.agg(
        F.count_if(F.col("split") == "train").alias("train_blocks"),
        F.count_if(F.col("split") == "val").alias("val_blocks"),
        F.coalesce(F.sum(F.when(F.col("split") == "train", F.col("n_real"))), F.lit(0)).cast("long").alias("train_tokens"),
        F.coalesce(F.sum(F.when(F.col("split") == "val", F.col("n_real"))), F.lit(0)).cast("long").alias("val_tokens"),
        F.coalesce(F.sum(F.lit(s) - F.col("n_real")), F.lit(0)).cast("long").alias("pad_tokens"),
    )
    d = documents
    slots = (F.col("train_blocks") + F.col("val_blocks")) * s
    real = F.col("train_tokens") + F.col("val_tokens")
    return b.select(
        F.lit(d).cast("long").alias("documents"),
        real.alias("tokens"),
        F.lit(d).cast("long").alias("eos_count"),
        F.lit(s).alias("block_size"),
        "train_blocks",
        "val_blocks",
        "train_tokens",
        "val_tokens",
        "pad_tokens",
        F.try_divide(100.0 * real, slots).alias("utilization_percent"),
        F.lit(vocab_size).cast("int").alias("vocab_size"),
        F.lit(cfg.eos_id).alias("eos_token_id"),
        F.lit(cfg.pad_id).alias("pad_token_id"),
        F.lit(cfg.bos_id).alias("bos_token_id"),
        F.lit(cfg.train_split).alias("train_split"),
        F.try_divide(100.0 * F.col("pad_tokens"), slots).alias("pad_percentage"),
        F.try_divide(real, F.lit(d)).alias("avg_tokens_per_doc"),
        F.try_divide(real, F.col("train_blocks") + F.col("val_blocks")).alias("avg_tokens_per_block"),
    )


def batch_draws(spark: SparkSession, steps: int, batch_size: int, n_blocks: int, seed: int = 0) -> DataFrame:
    """Repeatable uniform draws with replacement: ``(step, slot, block)`` of ``batch_size`` blocks per step.

    The block of a slot is 60 bits of ``md5(seed:step:slot) mod n_blocks``.
    """
    if n_blocks == 0:
        raise ValueError("no blocks to draw from")
    plan = spark.range(steps * batch_size).select(
        (F.col("id") / batch_size).cast("long").alias("step"),
        (F.col("id") % batch_size).cast("int").alias("slot"),
    )
    key = F.concat_ws(":", F.lit(str(seed)), F.col("step").cast("string"), F.col("slot").cast("string"))
    return plan.withColumn("block", (F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % F.lit(n_blocks)))


def batch_plan(
    blocks: DataFrame,
    steps: int,
    batch_size: int,
    seed: int = 0,
    split: str = "train",
    n_blocks: int | None = None,
) -> DataFrame:
    """P7 over blocks that are not written: the draws and, by an equi-join, their arrays (see ``packed.lookup`` for written ones)."""
    chosen = blocks.where(F.col("split") == split)
    # ``split_block_counts`` gives the count from the packing totals without a pass.
    n = chosen.count() if n_blocks is None else n_blocks
    return batch_draws(blocks.sparkSession, steps, batch_size, n, seed).join(chosen.drop("split"), "block")


def split_block_counts(total: int, cut: int, block_size: int) -> dict[str, int]:
    """Blocks per split from the token total and the cut (ceil division)."""
    return {"train": -(-cut // block_size), "val": -(-(total - cut) // block_size)}


def batch_contract(batches: DataFrame, block_size: int, accumulation: int = 1) -> DataFrame:
    """Per step, shapes agree, the mask is boolean, and the token budget."""
    mask_bool = F.transform("loss_mask", lambda m: m == F.lit(1))
    shaped = batches.select(
        "step",
        F.size("input_ids").alias("n_ids"),
        F.size("labels").alias("n_labels"),
        F.size(mask_bool).alias("n_mask"),
        F.size(F.filter(mask_bool, lambda m: m)).alias("n_true"),
    )
    return shaped.groupBy("step").agg(
        F.count("*").alias("batch_size"),
        F.bool_and((F.col("n_ids") == block_size) & (F.col("n_labels") == block_size) & (F.col("n_mask") == block_size)).alias(
            "same_shape"
        ),
        F.sum("n_true").cast("long").alias("masked_tokens"),
        (F.count("*") * F.lit(block_size * accumulation)).cast("long").alias("tokens_per_step"),
    )
