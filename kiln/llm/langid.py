"""Language identification: averaged hashed subword embeddings under a linear softmax.

A subword is a 3- or 4-gram of bytes inside a word (with the separators
around it); each is hashed to a row of an embedding table, the rows of a
text are averaged, and a linear softmax over the languages follows.  The
model is trained in numpy by stochastic gradient descent on a bounded
sample of labelled rows; a temperature fitted on rows left out of the
descent calibrates the probabilities.  A text is rejected if its best
calibrated probability is nearer to chance than to the least certain of the
rows left out that were told right (their ``certain`` quantile).

Average and softmax input are both linear, so scoring folds the embedding
and the softmax weights into one small table of logits per subword and sums
its rows over the whole text: one vectorised pass over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import drawn, pieces, trim, utf8

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

#: ASCII case is folded, digits share one class, separators and controls become a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[0x30:0x3A] = 0x30
_FOLD[:0x21] = 0x20


@dataclass(frozen=True)
class Settings:
    """``per_language`` (about) and ``rows`` (at most) bound the training sample, drawn by a hash of the key."""

    bits: int = 15
    dim: int = 16
    per_language: int = 500
    rows: int = 5_000
    epochs: int = 4  # or as many as make
    steps: int = 16_000
    rate: float = 0.5
    left_out: int = 5  # every fifth sampled row calibrates
    certain: float = 0.001
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # (2**bits + 1, languages): logits per subword; the last row is empty
    bias: np.ndarray
    temperature: float
    bits: int
    reject_below: float


def subwords(raw: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the 3-gram and of the 4-gram that start at each byte; 2**bits where there is none.

    A gram must not have a separator strictly inside.
    """
    b = _FOLD[raw].astype(np.uint32)
    n, none = len(b), np.uint32(1 << bits)
    gap = b == 0x20
    three, four = np.full(n, none, np.uint32), np.full(n, none, np.uint32)
    shift = np.uint32(32 - bits)
    if n >= 3:
        h = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        three[:-2] = (h * np.uint32(2654435761)) >> shift
        three[:-2][gap[1:-1]] = none
    if n >= 4:
        h = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
        four[:-3] = h >> shift
        four[:-3][gap[1:-2] | gap[2:-1]] = none
    return three, four


def padded(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes with a space before each text and at the end, start of each row)."""
    for i, j, lo, hi in pieces(offsets, data):
        edge = offsets[i : j + 1].clip(lo, hi) - lo
        out = np.full(hi - lo + (j - i) + 1, 0x20, np.uint8)
        start = edge[:-1] + np.arange(j - i)
        keep = np.ones(len(out), bool)
        keep[start] = keep[-1] = False
        out[keep] = data[lo:hi]
        yield i, j, out, start


def _sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, start, axis=0)


def logits(model: Model, column: pa.Array) -> np.ndarray:
    """Mean logit row of each text (zero where a text has no subword)."""
    offsets, data = utf8(column)
    n, width = len(offsets) - 1, len(model.languages)
    total, grams = np.zeros((n, width)), np.zeros(n)
    for i, j, raw, start in padded(offsets, data):
        for bucket in subwords(raw, model.bits):
            total[i:j] += _sums(model.table[bucket], start)
            grams[i:j] += _sums((bucket < (1 << model.bits)).astype(np.float32), start)
    return total / np.maximum(grams, 1)[:, None] + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _rows(labelled: DataFrame, key: str, text: str, lang: str, s: Settings) -> DataFrame:
    """The bounded sample: keys first (narrow), then their texts, one row a key."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")
    )
    keys = drawn(rows.select("k", "l").distinct(), "l", F.lit(s.per_language)).select("k").distinct()
    keys = keys.orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(s.rows)
    return rows.join(F.broadcast(keys), "k", "left_semi").groupBy("k").agg(F.min(F.struct("l", "t")).alias("r")).select("k", "r.l", "r.t")


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings | None = None) -> Model:
    """Fit a model on a bounded sample of the rows given; rows without text or label take no part.

    Tasks turn each sampled text into its subword counts (at most 2**bits
    pairs), and only those reach the driver.
    """
    s = settings or Settings()
    size = 1 << s.bits
    narrow = np.uint16 if s.bits <= 16 else np.uint32

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            offsets, data = utf8(frame.column("t"))
            keys, langs = frame.column("k").cast(pa.string()).to_pylist(), frame.column("l").to_pylist()
            for row in range(frame.num_rows):
                lo, hi = offsets[row], offsets[row + 1]
                bag = np.zeros(size + 1, np.int64)
                for _, _, raw, _ in padded(np.array([0, hi - lo]), data[lo:hi]):
                    for bucket in subwords(raw, s.bits):
                        bag += np.bincount(bucket, minlength=size + 1)
                at = np.flatnonzero(bag[:size])
                if len(at):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "k": pa.array([keys[row]], pa.string()),
                            "l": pa.array([langs[row]], pa.string()),
                            "at": pa.array([at.astype(narrow).tobytes()], pa.binary()),
                            "n": pa.array([bag[at].astype(np.float32).tobytes()], pa.binary()),
                        }
                    )

    rows = _rows(labelled, key, text, lang, s).mapInArrow(counted, "k string, l string, at binary, n binary").collect()
    rows.sort(key=lambda r: (r.k or "", r.l))
    languages = tuple(sorted({r.l for r in rows}))
    if not languages:
        return Model((), np.zeros((size + 1, 0), np.float32), np.zeros(0), 1.0, s.bits, 0.0)
    bags = []
    while rows:  # the driver holds a sampled text once
        r = rows.pop()
        n = np.frombuffer(r.n, np.float32)
        bags.append((np.frombuffer(r.at, narrow), n / n.sum(), languages.index(r.l)))
    bags.reverse()
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(bags))
    test = order[:: s.left_out] if len(bags) >= 10 * s.left_out else order[:0]
    fit = np.setdiff1d(order, test)
    share = np.bincount([bags[i][2] for i in fit], minlength=len(languages)).astype(float)
    weight = np.where(share > 0, len(fit) / (np.maximum(share, 1) * np.count_nonzero(share)), 0)

    embed = rng.normal(0, 1 / s.dim, (size, s.dim)).astype(np.float32)
    out = np.zeros((s.dim, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    epochs = max(s.epochs, -(-s.steps // len(fit)))
    steps, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            at, share_of, y = bags[i]
            rate = s.rate * (1 - step / steps)
            step += 1
            mean = share_of @ embed[at]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= min(weight[y], 4.0)
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            # a subword's gradient is its share; the factor keeps long texts from freezing the table
            embed[at] -= (rate * 10 * share_of)[:, None] * back
    fused = np.vstack([embed @ out, np.zeros((1, len(languages)), np.float32)]).astype(np.float32)
    if not len(test):
        test = fit
    z = np.array([bags[i][1] @ fused[bags[i][0]] + bias for i in test])
    y = np.array([bags[i][2] for i in test])
    grid = np.geomspace(0.05, 20, 121)
    # Labels smoothed as if one more row of each language had been seen, so that a
    # separable sample does not drive the temperature to zero.
    soft = np.full((len(y), len(languages)), 1 / (len(y) + len(languages)))
    soft[np.arange(len(y)), y] += 1 - soft.sum(axis=1)
    losses = [-(soft * np.log(softmax(z / t) + 1e-300)).sum(axis=1).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    return Model(languages, fused, bias.astype(float), temperature, s.bits, rejection_level(softmax(z / temperature), y, s.certain))


def rejection_level(p: np.ndarray, y: np.ndarray, certain: float) -> float:
    """Halfway between chance and the ``certain`` quantile of the winning probabilities of rows told right; chance if none is."""
    chance = 1 / p.shape[1]
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    return (chance + float(np.quantile(right, certain))) / 2 if len(right) else chance


def identify(spark, model: Model):
    """Arrow UDF text -> struct(lang, score, rejected)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def predict(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for texts in frames:
            known = np.array([bool(m.languages) and t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            if m.languages and len(texts):
                p = softmax(logits(m, texts) / m.temperature)
                best, score = p.argmax(axis=1), p.max(axis=1)
            else:
                best, score = np.zeros(len(texts), int), np.zeros(len(texts))
            best, score = np.where(known, best, len(m.languages)), np.where(known, np.clip(score, 0, 1), 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(~known | (score < m.reject_below))],
                ["lang", "score", "rejected"],
            )
        trim()

    return predict


def with_language(docs: DataFrame, model: Model, text: str | Column = "text", column: str = "language") -> DataFrame:
    """Add struct ``column`` (lang, score, rejected) predicted from each whole text.

    A null text and a text without a letter get ``und``, score 0, rejected;
    so does every text if nothing could be learned (no labelled row).
    Equal texts get equal results; an empty table stays empty; a column
    called ``column`` is replaced, all others pass through.
    """
    return docs.withColumn(column, identify(docs.sparkSession, model)(F.col(text) if isinstance(text, str) else text))
