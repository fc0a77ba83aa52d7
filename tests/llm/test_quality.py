import numpy as np
import pyarrow as pa
from llm_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F

from kiln.llm import catalog, quality
from kiln.llm.common import learnable, table

SMALL = quality.Settings(bits=12, per_label=60, steps=1500)
SF01 = SF001.replace("0.001", "0.01")


def _model(spark, settings=SMALL):
    return quality.train(table(spark, SF01, "documents"), table(spark, SF01, "labels").where(learnable("doc_id", 4, 2)), settings=settings)


def test_held_out_accuracy_and_columns(spark):
    rows = catalog.op13_quality(spark, SF01)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == table(spark, SF01, "documents").count()
    judged = rows.join(table(spark, SF01, "labels").select("doc_id", "quality"), "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in judged]
    assert sum(right) / len(right) >= 0.95
    assert np.mean([r.predicted for r in judged if r.quality == 1]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in judged)


def brute(model, text):
    """One feature after the other, hashed by itself; the mean of their numbers."""
    raw = b" " + (text or "").encode() + b" "
    table_, none, buckets = model.table.astype(float), 1 << model.bits, []
    shift = 32 - model.bits
    folded = bytes(0x20 if c in (0x20, 9, 10, 11, 12, 13) else c for c in raw)
    for i in range(len(folded) - 2):
        if folded[i + 1] != 0x20:
            h = int.from_bytes(folded[i : i + 3], "little")
            buckets.append(((h * 2654435761) & 0xFFFFFFFF) >> shift)
    for i in range(len(folded) - 3):
        if 0x20 not in folded[i + 1 : i + 3]:
            h = int.from_bytes(folded[i : i + 4], "little")
            buckets.append((((h ^ (h >> 15)) * 2246822519) & 0xFFFFFFFF) >> shift)
    one = lambda w: int(quality.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    words = [one(w) for w in folded.split()]
    buckets += [w >> (64 - model.bits) for w in words]
    for a, b in zip(words[:-1], words[1:], strict=True):
        h = 0 if a == b else int(quality.mix(np.array([((a * 3) & (2**64 - 1)) ^ b], np.uint64))[0])
        buckets.append(h >> (64 - model.bits))
    assert none not in buckets
    z = (sum(table_[b] for b in buckets) / max(1, len(buckets))) + model.offset
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_brute_force_sum_whatever_the_batch(spark, documents):
    model = _model(spark)
    texts = [r.text for r in table(spark, SF001, "documents").limit(40).collect()]
    texts += [None, "", " \n", "a", "x y", "de de de de", "ÉAN!! ÉAN!!", "漢字 かな", "a\tb\x0bc", "word"]
    z = quality.logits(model, pa.array(texts))
    assert np.allclose(1 / (1 + np.exp(-z)), [brute(model, t) for t in texts], atol=1e-5)
    assert np.allclose(z, [quality.logits(model, pa.array([t]))[0] for t in texts], atol=1e-9)
    long = pa.array(["plain words again " * 200_000, "the of and"])  # several steps
    assert abs(quality.logits(model, long)[0] - quality.logits(model, long.slice(0, 1))[0]) < 1e-9


def test_odd_texts_and_tables(spark, documents):
    model = _model(spark)
    odd = documents([(1, None), (2, ""), (3, " \t"), (4, "same text"), (4, "same text"), (None, "no key")]).withColumn("quality", F.lit("old")).withColumn("score", F.lit("kept"))
    rows = {(r.doc_id, r.text): r for r in quality.with_quality(odd, model).collect()}
    alone = 1 / (1 + np.exp(-model.offset))
    assert all(abs(rows[k].quality - alone) < 1e-12 for k in ((1, None), (2, ""), (3, " \t")))
    assert all(0 <= r.quality <= 1 and r.score == "kept" for r in rows.values())
    assert quality.with_quality(odd, model).where("doc_id = 4").select("quality").distinct().count() == 1
    assert quality.with_quality(documents([]), model).count() == 0


def test_nothing_to_learn_gives_the_share(spark, documents):
    kind = "doc_id bigint, quality int, text string"
    docs = documents([(1, "a b"), (2, "c d"), (3, "e")])
    none = quality.train(docs, spark.createDataFrame([], kind), settings=SMALL)
    assert quality.with_quality(docs, none).select("quality").distinct().first()[0] == 0.5
    one = quality.train(docs, spark.createDataFrame([(1, 1, ""), (2, 1, ""), (3, 7, ""), (None, 0, "")], kind), settings=SMALL)
    assert abs(quality.with_quality(docs, one).first().quality - 3 / 4) < 1e-9


def test_calibration_recovers_a_slope():
    rng = np.random.default_rng(1)
    z = rng.normal(size=20_000) * 3
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * z + 1)))).astype(float)
    slope, offset = quality.calibrate(z, y, np.ones(len(z)))
    assert abs(slope - 0.5) < 0.05 and abs(offset - 1) < 0.1
