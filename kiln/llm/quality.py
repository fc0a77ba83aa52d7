"""Quality classifier: supervised subword embeddings.

A text is its words, its pairs of neighbouring words (all pairs of equal
words are one feature, so that repetition is seen in words never met) and the
character 3- and 4-grams of its words (bytes, with the separators around a
word, case kept).  Each is hashed to a row of one embedding table; a document is the average of its rows, and a softmax
over the two labels follows.  Table and softmax are learned in numpy by
stochastic gradient descent on a bounded sample of labelled rows; a slope
and an offset fitted on rows left out of the descent, weighted to the shares
of the labels, turn the difference of the two logits into a probability.

Average and softmax input are linear, so scoring needs one number per hashed
row: a vectorised pass over the bytes sums it over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import IS_SPACE, drawn, mix, trim, utf8, word_hashes, word_spans, written
from kiln.llm.langid import padded

_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[IS_SPACE] = 0x20


@dataclass(frozen=True)
class Settings:
    """``per_label`` (about) and ``rows`` (at most) bound the training sample, drawn by a hash of the key.

    The driver holds at most ``rows`` bags of 2**``bits`` features.
    """

    bits: int = 16
    dim: int = 16
    per_label: int = 600
    rows: int = 1_300
    steps: int = 12_000
    rate: float = 0.5
    left_out: int = 4  # every fourth sampled row calibrates
    seed: int = 11


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # (2**bits + 1): difference of the logits per feature; the last row is empty
    offset: float
    bits: int


def features(raw: np.ndarray, start: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Buckets of the word, the pair with the word before, the 3-gram and the 4-gram at each byte; 2**bits where there is none.

    A gram has no separator strictly inside; ``raw`` has one before each text (at ``start``) and at the end.
    """
    b = _BYTES[raw].astype(np.uint32)
    n, none, shift = len(b), np.uint32(1 << bits), np.uint32(32 - bits)
    gap = b == 0x20
    word, pair, three, four = (np.full(n, none, np.uint32) for _ in range(4))
    starts, ends = word_spans(raw)
    hashes = word_hashes(raw, starts, ends)
    word[starts] = (hashes >> np.uint64(64 - bits)).astype(np.uint32)
    if len(starts) > 1:
        first = np.unique(np.searchsorted(starts, start))  # words with none before them in their text
        h = mix(hashes[:-1] * np.uint64(3) ^ hashes[1:])
        h[hashes[:-1] == hashes[1:]] = 0
        pair[starts[1:]] = (h >> np.uint64(64 - bits)).astype(np.uint32)
        pair[starts[first[first < len(starts)]]] = none
    if n >= 3:
        h = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        three[:-2] = (h * np.uint32(2654435761)) >> shift
        three[:-2][gap[1:-1]] = none
    if n >= 4:
        h = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
        four[:-3] = h >> shift
        four[:-3][gap[1:-2] | gap[2:-1]] = none
    return word, pair, three, four


def logits(model: Model, column: pa.Array) -> np.ndarray:
    """Difference of the logits of each text (the offset alone where a text has no feature)."""
    offsets, data = utf8(column)
    n = len(offsets) - 1
    total, count = np.zeros(n), np.zeros(n)
    for i, j, raw, start in padded(offsets, data):
        for bucket in features(raw, start, model.bits):
            total[i:j] += np.add.reduceat(model.table[bucket], start, dtype=np.float64)
            count[i:j] += np.add.reduceat(bucket < (1 << model.bits), start, dtype=np.int64)
    return total / np.maximum(count, 1) + model.offset


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, s: Settings) -> tuple[DataFrame, dict[int, int]]:
    """The bounded sample (k, y, t), one row a key, and how many keys each label has."""
    keys = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and k is not null")
    keys = keys.groupBy("k").agg(F.min("y").alias("y"))
    sizes = {r.y: r["count"] for r in keys.groupBy("y").count().collect()}
    ids = drawn(keys, "y", F.lit(s.per_label)).orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(s.rows).select("k", "y")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return texts.join(F.broadcast(ids), "k").groupBy("k").agg(F.max("y").alias("y"), F.max("t").alias("t")), sizes


def bags(rows: DataFrame, s: Settings) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(features, shares, label) of each sampled text, in the order of a hash of the key."""
    size = 1 << s.bits
    narrow = np.uint16 if s.bits <= 16 else np.uint32

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            offsets, data = utf8(frame.column("t"))
            keys, labels = frame.column("k").cast(pa.string()).to_pylist(), frame.column("y").to_pylist()
            for row in range(frame.num_rows):
                lo, hi = offsets[row], offsets[row + 1]
                bag = np.zeros(size + 1, np.int64)
                for _, _, raw, start in padded(np.array([0, hi - lo]), data[lo:hi]):
                    for bucket in features(raw, start, s.bits):
                        bag += np.bincount(bucket, minlength=size + 1)
                at = np.flatnonzero(bag[:size])
                made = {"k": [keys[row]], "y": pa.array([labels[row]], pa.int32()), "at": [at.astype(narrow).tobytes()], "n": [bag[at].astype(np.float32).tobytes()]}
                yield pa.RecordBatch.from_pydict(made)

    found = rows.mapInArrow(counted, "k string, y int, at binary, n binary").orderBy(F.xxhash64("k"), "k").collect()
    out = []
    for r in found:
        n = np.frombuffer(r.n, np.float32)
        out.append((np.frombuffer(r.at, narrow), n / max(1.0, float(n.sum())), r.y))
    return out


def descend(sample: list[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> np.ndarray:
    """Per feature the difference of the two logits, after stochastic gradient descent with both labels equally often."""
    rng = np.random.default_rng(s.seed)
    embed = rng.uniform(-1 / s.dim, 1 / s.dim, ((1 << s.bits), s.dim)).astype(np.float32)
    out = np.zeros((s.dim, 2), np.float32)
    of = [[i for i, (_, _, y) in enumerate(sample) if y == v] for v in (0, 1)]
    for step in range(s.steps):
        own = of[step % 2]
        at, share, y = sample[own[int(rng.integers(len(own)))]]
        rate = s.rate * (1 - step / s.steps)
        mean = share @ embed[at]
        z = mean @ out
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1
        back = out @ p
        out -= rate * np.outer(mean, p)
        # a feature's gradient is its share; the factor keeps long texts from freezing the table
        embed[at] -= (rate * 10 * share)[:, None] * back
    return (embed @ (out[:, 1] - out[:, 0])).astype(np.float32)


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the weighted logistic fit of y on z; labels are smoothed as if a row of each label more had been seen."""
    soft = (y * len(y) + 0.5) / (len(y) + 1)
    x = np.column_stack([z, np.ones(len(z))])
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        change = np.linalg.solve(hessian, x.T @ (weight * (p - soft)) + 1e-6 * b)
        b -= change * min(1.0, 4 / max(1e-12, float(np.abs(change).max())))
        if np.abs(change).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings | None = None) -> Model:
    """Fit a model on a bounded sample of the labelled documents; labels other than 0 and 1 and null keys take no part.

    Without labels of both kinds every text gets the smoothed share of label 1.
    """
    s = settings or Settings()
    rows, sizes = _sample(docs, labels, key, text, label, s)
    sample = bags(written(rows, "quality-sample"), s)
    n = [sum(y == v for _, _, y in sample) for v in (0, 1)]
    if min(n) < 2:
        share = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
        return Model(np.zeros((1 << s.bits) + 1, np.float32), float(np.log(share / (1 - share))), s.bits)
    seen = [0, 0]
    test, fit = [], []
    for i, (_, _, y) in enumerate(sample):  # of each label alike
        (test if seen[y] % s.left_out == s.left_out - 1 else fit).append(i)
        seen[y] += 1
    table = descend([sample[i] for i in fit], s)
    if len({sample[i][2] for i in test}) < 2:
        test = fit
    z = np.array([float(sample[i][1] @ table[sample[i][0]]) for i in test])
    y = np.array([sample[i][2] for i in test], float)
    weight = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    slope, offset = calibrate(z, y, weight / weight.mean())
    return Model(np.append(table * slope, 0).astype(np.float32), offset, s.bits)


def with_quality(docs: DataFrame, model: Model, text: str | Column = "text", column: str = "quality") -> DataFrame:
    """Add the probability (0 to 1) that the label of each whole text is 1.

    Null and empty texts, and those of separators only, have no feature and
    get the probability that the offset alone gives.  Equal texts get equal
    scores, whatever batch they come in; very long texts are summed step by
    step; an empty table stays empty; a column called ``column`` is replaced,
    all others pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in frames:
            yield pa.array(1 / (1 + np.exp(-np.clip(logits(shared.value, texts), -30, 30))), pa.float64())
        trim()

    return docs.withColumn(column, score(F.col(text) if isinstance(text, str) else text))
