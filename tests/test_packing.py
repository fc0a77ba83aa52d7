import random

from pyspark.sql import functions as F

from kiln.config import PackConfig
from kiln.operators import packing


def spark_pack(spark, docs, cfg):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "seq long, ids array<int>")
    blocks, total, cut = packing.pack_blocks(df, cfg)
    rows = blocks.orderBy("split", "block").collect()
    out = {"train": [], "val": []}
    for r in rows:
        out[r.split].append((list(r.input_ids), list(r.labels), list(r.loss_mask)))
    return out, total, cut


def test_golden_case(spark):
    cfg = PackConfig(block_size=6, train_split=1.0, eos_id=2, pad_id=0)
    out, total, cut = spark_pack(spark, [[1, 2], [3]], cfg)
    assert out["train"] == [([1, 2, 2, 3, 2, 0], [2, 2, 3, 2, 0, 0], [1, 1, 1, 1, 1, 0])]
    assert out["val"] == []


def test_random_documents_keep_the_invariants(spark):
    random.seed(11)
    for s, split in ((16, 0.99), (7, 0.5), (5, 0.8)):
        docs = [[random.randint(4, 99) for _ in range(random.randint(0, 40))] for _ in range(60)]
        cfg = PackConfig(block_size=s, train_split=split)
        stream = [t for d in docs for t in d + [cfg.eos_id]]
        out, total, cut = spark_pack(spark, docs, cfg)
        assert (total, cut) == (len(stream), int(len(stream) * split))
        real = {}
        for name, blocks in out.items():
            assert all(len(x) == s for block in blocks for x in block)
            # the unpadded ids are the stream, only the last block is padded, and with pad alone
            real[name] = [t for ids, _, mask in blocks for t, m in zip(ids, mask) if m]
            assert all(all(mask) for _, _, mask in blocks[:-1])
            assert all(t == cfg.pad_id for ids, _, mask in blocks for t, m in zip(ids, mask) if not m)
            assert all(mask == sorted(mask, reverse=True) for _, _, mask in blocks)
            # a label is the next id of its block
            assert all(labels[i] == ids[i + 1] for ids, labels, _ in blocks for i in range(s - 1))
            assert all(labels[-1] == cfg.pad_id for _, labels, _ in blocks)
        assert real["train"] + real["val"] == stream and len(real["train"]) == cut


def test_exact_multiple_and_short_split(spark):
    cfg = PackConfig(block_size=4, train_split=0.75)
    out, total, cut = spark_pack(spark, [[5, 6, 7], [8, 9, 10, 11, 12, 13, 14]], cfg)
    assert total == 12 and cut == 9
    assert [b[0] for b in out["train"]] == [[5, 6, 7, 2], [8, 9, 10, 11], [12, 0, 0, 0]]
    assert [b[0] for b in out["val"]] == [[13, 14, 2, 0]]


def test_batch_plan_repeatable(spark):
    cfg = PackConfig(block_size=4, train_split=1.0)
    docs = spark.createDataFrame([(i, [i + 4] * 9) for i in range(20)], "seq long, ids array<int>")
    blocks, _, _ = packing.pack_blocks(docs, cfg)
    p1 = packing.batch_plan(blocks, 5, 3, seed=1).select("step", "slot", "block").orderBy("step", "slot").collect()
    p2 = packing.batch_plan(blocks, 5, 3, seed=1).select("step", "slot", "block").orderBy("step", "slot").collect()
    assert p1 == p2 and len(p1) == 15
    contract = packing.batch_contract(packing.batch_plan(blocks, 5, 3), 4).collect()
    assert all(r.same_shape and r.batch_size == 3 for r in contract)
