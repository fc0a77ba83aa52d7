"""The queries over the packed format on rows of their own: right rows, and what they leave on the disk."""

import glob
import hashlib
import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kiln import session
from kiln.config import PackConfig
from kiln.plans import catalog
from kiln.session import stage_table

S = PackConfig().block_size


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    """(folder, packed blocks by split) of documents with copies, and with a key or text that is not there."""
    rng, words = random.Random(4), [f"w{i:x}" for i in range(900)]
    texts = [" ".join(rng.choices(words, k=rng.randint(60, 400))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(40 + i, texts[i]) for i in range(9)] + [(None, "alone " * 60), (50, None)]
    rng.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("sf"))
    told = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "lang": ["en"] * len(rows), "source": ["x"] * len(rows), "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64())})
    pq.write_table(told, f"{folder}/documents.parquet")
    rank = {w: 4 + i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    stream = [x for t in [*texts, ""] for x in [*(rank[w] for w in t.split()), 2]]  # a text that is not there passes the filter and has no words
    cut = int(len(stream) * PackConfig().train_split)
    return folder, {"train": [stream[i : min(i + S, cut)] for i in range(0, cut, S)], "val": [stream[i : i + S] for i in range(cut, len(stream), S)]}


def left_behind(spark, run):
    """What ``run`` returns, and the stages that it wrote and left, by name and bytes."""
    top = session.checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    out = run()
    own = {d: sum(os.path.getsize(f) for f in glob.glob(f"{top}/{d}/**", recursive=True)) for d in set(os.listdir(top)) - before}
    return out, {d: n for d, n in own.items() if n > 0}


def no_stage_of_texts(left):
    return not [d for d in left if d.startswith(("filtered", "firsts", "word-"))]


def test_packed_source_keeps_no_copy_of_the_texts(spark, corpus):
    folder, blocks = corpus
    rows, left = left_behind(spark, lambda: catalog.q_packed_source(spark, folder).collect())
    got = {(r.split, r.block): r for r in rows}
    assert len(got) == len(rows) == sum(map(len, blocks.values()))
    for split, own in blocks.items():
        for i, real in enumerate(own):
            r, ids = got[split, i], real + [0] * (S - len(real))
            assert (r.n_real, r.input_ids, r.labels) == (len(real), ",".join(map(str, ids)), ",".join(map(str, [*ids[1:], 0])))
            assert r.loss_mask == ",".join(["1"] * len(real) + ["0"] * (S - len(real)))
    assert no_stage_of_texts(left)


def test_a_lean_stage_leaves_no_shuffle(spark):
    def files():
        dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    before = files()
    out = stage_table(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.collect_list("id").alias("ids")), "lean", lean=True)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert out.count() == 700 and spark.conf.get(session.SHUFFLE_CLEANUP, None) in (None, "false")
    session.drop_stage(out)
    assert not os.path.exists(out._stage.removeprefix("file:"))


def test_batch_plan_keeps_the_short_blocks_alone(spark, corpus):
    folder, blocks = corpus
    rows, left = left_behind(spark, lambda: catalog.q_batch_plan(spark, folder).collect())
    train = blocks["train"]
    draw = lambda i: int(hashlib.md5(f"0:{i // catalog.BATCH}:{i % catalog.BATCH}".encode()).hexdigest()[:15], 16) % len(train)
    want = [(i // catalog.BATCH, i % catalog.BATCH, draw(i), len(train[draw(i)])) for i in range(catalog.STEPS * catalog.BATCH)]
    assert sorted(map(tuple, rows)) == want
    assert no_stage_of_texts(left)
    written = sum(n for d, n in left.items() if d.startswith("packed-blocks"))
    assert 0 < written < 1.5 * 4 * S * sum(map(len, blocks.values()))


def test_batch_contract_over_short_blocks(spark, corpus):
    folder, blocks = corpus
    rows, left = left_behind(spark, lambda: catalog.q_batch_contract(spark, folder).collect())
    train = blocks["train"]
    drawn = [[int(hashlib.md5(f"0:{i}:{j}".encode()).hexdigest()[:15], 16) % len(train) for j in range(catalog.BATCH)] for i in range(catalog.STEPS)]
    want = [(i, catalog.BATCH, True, sum(len(train[b]) for b in own), 4 * S * catalog.BATCH) for i, own in enumerate(drawn)]
    assert sorted((r.step, r.batch_size, r.same_shape, r.masked_tokens, r.tokens_per_step) for r in rows) == want
    assert no_stage_of_texts(left)
