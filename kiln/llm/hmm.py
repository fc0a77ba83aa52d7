"""Language-model scoring with a hidden Markov model.

Tokens are lower-cased words and one end per text.  A state emits a class
and the class a word: the commonest words are classes of their own, every
other word belongs to one of a fixed number of classes by its first and
last letters, within which it has the smoothed share of its count.  So a
vocabulary of any size has a model of bounded size, and the likelihood of a
text under it is exact.

1. Word counts of the whole training part: documents are dealt to blocks; a
   block sends each of its distinct words once to the word's bucket, with its
   count, and gets the corpus count back.  The bucket summaries give the
   number of tokens, the distinct ones, the commonest words and class totals.
2. Each block turns its texts into class sequences, with the sums of
   log10 counts that the base score and the words' shares need.
3. Baum-Welch: tasks run scaled forward and backward recursions over their
   training sequences and add up expected counts, which are summed over all
   partitions; first some rounds on a bounded sample to part the states,
   then rounds over the whole training part.
4. The scaled forward recursion scores every text in double precision.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import long_word_hashes, runs, trim, word_hashes, word_spans, written

#: A word holds no separator, so this cannot be one.
END = b"\n"


@dataclass(frozen=True)
class Settings:
    """``common`` words have classes of their own, ``classes`` hold the rest; ``sample`` documents warm up."""

    states: int = 8
    common: int = 2_047
    classes: int = 2_048
    sample: int = 1_500
    warm: int = 10
    rounds: int = 3
    stay: float = 0.9
    prior: float = 50.0  # pseudo-counts that draw a state's emissions to the corpus'
    group: int = 400_000  # tokens of sequences that are run side by side, or held of a longer one
    spread: int = 2  # blocks per shuffle partition; there is one bucket per partition
    seed: int = 13

    @property
    def width(self) -> int:
        return self.common + self.classes


def word_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[:3] + b"|" + word[-2:]) % classes


_END_HASH = word_hashes(np.frombuffer(END, np.uint8), np.array([0]), np.array([1]))[0]


def _pack(*parts: bytes) -> bytes:
    import zstandard

    head = struct.pack(f"<{len(parts) + 1}q", len(parts), *(len(p) for p in parts))
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = struct.unpack_from("<q", raw)[0]
    at, out = 8 * (n + 1), []
    for size in struct.unpack_from(f"<{n}q", raw, 8):
        out.append(raw[at : at + size])
        at += size
    return out


def _split(words: bytes) -> list[bytes]:
    return [w or END for w in words.split(b" ")]


def _join(words: list[bytes]) -> bytes:
    return b" ".join(b"" if w == END else w for w in words)


class Block:
    """Distinct words of some texts in the order of their hashes, and the texts as indexes into them.

    Buckets are ranges of the hash, so a bucket's words stand together, in an
    order that does not depend on the order of the texts.
    """

    def __init__(self, texts: list[bytes | None], buckets: int):
        raw = b"\n".join((t or b"").lower() for t in texts)
        data = np.frombuffer(raw, np.uint8)
        starts, ends = word_spans(data)
        row = np.searchsorted(np.cumsum([len(t or b"") + 1 for t in texts]), starts, "right")
        count = np.bincount(row, minlength=len(texts))
        self.lengths = count + 1  # with the end
        hashes = np.full(int(self.lengths.sum()), _END_HASH)
        place = np.arange(len(starts)) + row
        hashes[place] = long_word_hashes(data, starts, ends)
        word_at = np.full(len(hashes), -1, np.int64)
        word_at[place] = np.arange(len(starts))
        kinds, first, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
        # length and sum of the bytes tell words apart that share a hash
        total = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
        check = np.zeros(len(hashes), np.int64)
        check[place] = (total[ends] - total[starts]) << np.int64(20) | (ends - starts) & np.int64((1 << 20) - 1)
        if (check != check[first][self.ids]).any():
            spelled = [raw[starts[w] : ends[w]] if w >= 0 else END for w in word_at.tolist()]
            exact = sorted(set(zip(hashes.tolist(), spelled, strict=True)))
            place_of = {w: i for i, (_, w) in enumerate(exact)}
            self.ids = np.array([place_of[w] for w in spelled])
            self.words, kinds = [w for _, w in exact], np.array([h for h, _ in exact], np.uint64)
        else:
            at = word_at[first]
            inside = np.flatnonzero(at >= 0)
            self.words = [END] * len(kinds)
            for i, a, b in zip(inside.tolist(), starts[at[inside]].tolist(), ends[at[inside]].tolist(), strict=True):
                self.words[i] = raw[a:b]
        self.bucket = ((kinds >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def ranges(self) -> Iterator[tuple[int, int, int]]:
        cut = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield int(self.bucket[a]), a, b


def _summary(words: list[bytes], counts: np.ndarray, s: Settings) -> bytes:
    """Of a bucket: tokens and distinct ones, those of each class, and its commonest words."""
    known = counts > 0
    of = np.array([word_class(w, s.classes) for w in words], np.int64)
    total = np.bincount(of, weights=counts, minlength=s.classes).astype(np.int64)
    kinds = np.bincount(of, weights=known, minlength=s.classes).astype(np.int64)
    best = np.lexsort((np.array(words, object), -counts))[: s.common] if len(words) else np.zeros(0, int)
    best = best[counts[best] > 0]
    return _pack(
        struct.pack("<qq", int(counts.sum()), int(known.sum())), total.tobytes(), kinds.tobytes(), _join([words[i] for i in best]), counts[best].tobytes()
    )


def _counted(rows: DataFrame, partitions: int, buckets: int, s: Settings) -> DataFrame:
    """(block, bucket, payload): a bucket's answer to each block, and under block -1 its summary."""

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in runs((f.select(["block", "learn", "t"]) for f in frames), 0):
            b = Block([r[2] for r in held], buckets)
            learned = np.repeat(np.array([r[1] for r in held], bool), b.lengths)
            counts = np.bincount(b.ids[learned], minlength=len(b.words)).astype(np.int64)
            out = [(n, block, _pack(_join(b.words[x:y]), counts[x:y].tobytes())) for n, x, y in b.ranges()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.binary())],
                ["bucket", "block", "payload"],
            )
        trim()

    def answer(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in runs(frames, 0):
            index: dict[bytes, int] = {}
            asked = []
            for _, block, payload in held:
                words, counts = _unpack(payload)
                asked.append((block, np.array([index.setdefault(w, len(index)) for w in _split(words)]), np.frombuffer(counts, np.int64)))
            total = np.zeros(len(index), np.int64)
            for _, which, counts in asked:
                total[which] += counts
            blocks = [-1] + [a[0] for a in asked]
            payloads = [_summary(list(index), total, s)] + [_pack(total[a[1]].tobytes()) for a in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array([bucket] * len(blocks), pa.int32()), pa.array(payloads, pa.binary())], ["block", "bucket", "payload"]
            )

    asked = rows.sortWithinPartitions("block").mapInArrow(ask, "bucket int, block int, payload binary")
    return asked.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, "block int, bucket int, payload binary")


@dataclass
class Vocabulary:
    """Corpus counts in bounded form."""

    tokens: int
    distinct: int
    common: dict[bytes, tuple[int, int]]  # word -> (class, count)
    totals: np.ndarray  # count of each class
    share: np.ndarray  # log10 of what a word's count + 1 is divided by, 0 for common words

    def spelled(self, words: list[bytes], s: Settings) -> np.ndarray:
        own = self.common
        return np.array([own[w][0] if w in own else s.common + word_class(w, s.classes) for w in words], np.int64)


def _merged(one: list, two: list, s: Settings) -> list:
    """Sums of two summaries, with the commonest words of both."""
    words = sorted([*one[4], *two[4]], key=lambda x: (-x[1], x[0]))[: s.common]
    return [one[0] + two[0], one[1] + two[1], one[2] + two[2], one[3] + two[3], words]


def vocabulary(counted: DataFrame, s: Settings) -> Vocabulary:
    """Add up the bucket summaries, a bounded one at a time."""
    out = [0, 0, np.zeros(s.classes, np.int64), np.zeros(s.classes, np.int64), []]
    for row in counted.where("block = -1").select("payload").toLocalIterator():
        head, total, kinds, words, counts = _unpack(row.payload)
        n, v = struct.unpack("<qq", head)
        numbers = np.frombuffer(counts, np.int64).tolist()
        best = list(zip(_split(words), numbers, strict=True)) if numbers else []
        out = _merged(out, [n, v, np.frombuffer(total, np.int64), np.frombuffer(kinds, np.int64), best], s)
    n, v, total, kinds, words = out
    common = {w: (i, c) for i, (w, c) in enumerate(words)}
    total, kinds = total.copy(), kinds.copy()
    for w, (_, c) in common.items():
        total[word_class(w, s.classes)] -= c
        kinds[word_class(w, s.classes)] -= 1
    totals = np.zeros(s.width)
    totals[: len(words)] = [c for _, c in words]
    totals[s.common :] = total
    share = np.zeros(s.width)
    share[s.common :] = np.log10(total + kinds + 1)
    return Vocabulary(n, v, common, totals, share)


def _encoded(rows: DataFrame, counted: DataFrame, vocab: Vocabulary, buckets: int, s: Settings) -> DataFrame:
    """Class sequences and sums of log10(count + 1): of all tokens, and of those in shared classes."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        v = shared.value
        b = Block(left.column("t").to_pylist(), buckets)
        told = dict(zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist(), strict=True))
        count = np.concatenate([np.frombuffer(_unpack(told[n])[0], np.int64) for n, _, _ in b.ranges()])
        spelled = v.spelled(b.words, s)
        log = np.log10(count + 1.0)
        shares = np.where(spelled >= s.common, log - v.share[spelled], 0.0)
        start = np.cumsum(b.lengths) - b.lengths
        sums = lambda x: np.add.reduceat(x[b.ids], start)
        sequence = spelled[b.ids].astype(np.uint16)
        parts = np.split(sequence, start[1:])
        return pa.table(
            {
                "k": left.column("k"),
                "held": left.column("held"),
                "learn": left.column("learn"),
                "n_tokens": pa.array(b.lengths, pa.int64()),
                "n_known": pa.array(sums((count > 0).astype(np.int64)), pa.int64()),
                "log_counts": pa.array(sums(log), pa.float64()),
                "log_shares": pa.array(sums(shares), pa.float64()),
                "classes": pa.array([p.tobytes() for p in parts], pa.binary()),
            }
        )

    answers = counted.where("block >= 0").select("block", "bucket", "payload")
    out = "k bigint, held boolean, learn boolean, n_tokens bigint, n_known bigint, log_counts double, log_shares double, classes binary"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, out)


@dataclass
class Model:
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (width, states)


def first_model(totals: np.ndarray, s: Settings) -> Model:
    """States that mostly stay, emitting the corpus' classes with random tilts."""
    rng = np.random.default_rng(s.seed)
    emit = (totals + 1)[:, None] * rng.gamma(2.0, 0.5, (s.width, s.states))
    move = np.full((s.states, s.states), (1 - s.stay) / max(1, s.states - 1))
    np.fill_diagonal(move, s.stay if s.states > 1 else 1.0)
    return Model(np.full(s.states, 1 / s.states), move, emit / emit.sum(axis=0))


def _groups(sequences: list[np.ndarray], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, lengths, classes by time then sequence) of sequences of similar length, longest first.

    At time t the sequences that still run are a prefix, so nothing is padded.
    """
    lengths = np.array([len(x) for x in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        room, end = limit, at
        while end < len(order) and (end == at or room >= lengths[order[end]]) and 4 * lengths[order[end]] >= lengths[order[at]]:
            room -= lengths[order[end]]
            end += 1
        which = order[at:end]
        size = lengths[which]
        flat = np.concatenate([sequences[i] for i in which]).astype(np.int64)
        time = np.concatenate([np.arange(n) for n in size])
        row = np.repeat(np.arange(len(which)), size)
        yield which, size, flat[np.lexsort((row, time))]
        at = end


def _running(size: np.ndarray) -> np.ndarray:
    """Offset of each time step in a group's flat order."""
    alive = np.searchsorted(-size, -np.arange(size[0]), "left")
    return np.concatenate([[0], np.cumsum(alive)])


def forward(model: Model, sequences: list[np.ndarray], limit: int) -> np.ndarray:
    """log10 likelihood of each class sequence by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    for which, size, flat in _groups(sequences, limit):
        edge = _running(size)
        log = np.zeros(len(which))
        alpha = np.broadcast_to(model.start, (len(which), len(model.start)))
        for t in range(size[0]):
            n = edge[t + 1] - edge[t]
            alpha = (alpha if t == 0 else alpha[:n] @ model.move) * model.emit[flat[edge[t] : edge[t + 1]]]
            scale = alpha.sum(axis=1)
            alpha = alpha / scale[:, None]
            log[:n] += np.log10(scale)
        out[which] = log
    return out


def _expected_long(model: Model, x: np.ndarray, step: int, start: np.ndarray, pair: np.ndarray, emit: np.ndarray) -> None:
    """Add the counts of one sequence, ``step`` tokens in memory at a time.

    The forward pass keeps one vector per cut; the backward pass runs each
    piece forward again from the vector before it, and carries its own vector
    over the cut, so every transition counts and only the first token starts.
    ``pair`` gets the counts without their factor ``move``.
    """

    def run(piece: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        seen = model.emit[piece]
        alphas, scale = np.empty_like(seen), np.empty(len(piece), seen.dtype)
        for t in range(len(piece)):
            alpha = (model.start if before is None else before @ model.move) * seen[t]
            scale[t] = alpha.sum()
            alphas[t] = before = alpha / scale[t]
        return seen, alphas, scale

    cuts = list(range(0, len(x), step))
    before: list[np.ndarray | None] = [None]
    for i in cuts[:-1]:
        before.append(run(x[i : i + step], before[-1])[1][-1].copy())
    ahead = None
    for i, own in zip(reversed(cuts), reversed(before), strict=True):
        piece = x[i : i + step].astype(np.int64)
        seen, alphas, scale = run(piece, own)
        for t in range(len(piece) - 1, -1, -1):
            beta = np.ones_like(model.start)
            if ahead is not None:
                pair += np.outer(alphas[t], ahead)
                beta = model.move @ ahead
            ahead = beta * seen[t] / scale[t]
            alphas[t] *= beta
        for state in range(alphas.shape[1]):
            emit[:, state] += np.bincount(piece, weights=alphas[:, state], minlength=len(emit))
    start += alphas[0]


def expected(model: Model, sequences: list[np.ndarray], s: Settings) -> list[np.ndarray]:
    """Expected counts [start, move, emit] over the sequences (forward-backward).

    Sequences of up to ``group`` tokens run side by side; longer ones alone, whole, in bounded memory.
    """
    small = Model(*(m.astype(np.float32) for m in (model.start, model.move, model.emit)))
    start, move, emit = np.zeros(s.states), np.zeros((s.states, s.states)), np.zeros((s.width, s.states))
    for x in sequences:
        if len(x) > s.group:
            _expected_long(small, x, s.group, start, move, emit)
    pair_of_long, move = move * model.move, np.zeros_like(move)
    for which, size, flat in _groups([x for x in sequences if len(x) <= s.group], s.group):
        edge = _running(size)
        alphas = np.empty((len(flat), s.states), np.float32)
        seen = small.emit[flat]
        scale = np.empty(len(flat), np.float32)
        alpha = np.broadcast_to(small.start, (len(which), s.states))
        for t in range(size[0]):
            a, b = edge[t], edge[t + 1]
            alpha = (alpha if t == 0 else alpha[: b - a] @ small.move) * seen[a:b]
            c = alpha.sum(axis=1)
            alpha = alpha / c[:, None]
            alphas[a:b], scale[a:b] = alpha, c
        beta = np.ones((0, s.states), np.float32)
        pair = np.zeros((s.states, s.states))
        for t in range(size[0] - 1, -1, -1):
            a, b = edge[t], edge[t + 1]
            full = np.ones((b - a, s.states), np.float32)
            if t + 1 < size[0]:
                lo, hi = edge[t + 1], edge[t + 2]
                ahead = beta * seen[lo:hi] / scale[lo:hi, None]
                pair += alphas[a : a + hi - lo].T @ ahead
                full[: hi - lo] = ahead @ small.move.T
            beta = full
            alphas[a:b] *= beta
        start += alphas[: edge[1]].sum(axis=0)
        move += pair * model.move
        for state in range(s.states):
            emit[:, state] += np.bincount(flat, weights=alphas[:, state], minlength=s.width)
    return [start, move + pair_of_long, emit]


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in column.to_pylist()]


def _held(frames: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of batches of about ``most`` tokens, so that many sequences run side by side."""
    for frame in frames:
        size = np.cumsum([len(x) // 2 for x in frame.column("classes").to_pylist()])
        at = 0
        while at < frame.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield frame.slice(at, end - at)
            at = end


def baum_welch(rows: DataFrame, model: Model, totals: np.ndarray, s: Settings) -> Model:
    """One round: expected counts of all partitions, summed in two steps, make the next model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for frame in _held(frames):
            found = expected(shared.value, _sequences(frame.column("classes")), s)
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            blob = np.concatenate([x.ravel() for x in total]).tobytes()
            yield pa.RecordBatch.from_pydict({"part": pa.array([zlib.crc32(blob) % 8], pa.int32()), "v": pa.array([blob], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, None
        for batch in batches:
            part = batch.column("part")[0]
            for v in batch.column("v"):
                total = total + np.frombuffer(v.as_py(), np.float64)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part.as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    found = rows.select("classes").mapInArrow(count, "part int, v binary").groupBy("part").applyInArrow(add, "part int, v binary").collect()
    if not found:
        return model
    total = np.sum([np.frombuffer(r.v, np.float64) for r in sorted(found, key=lambda r: r.part)], axis=0)
    n = s.states
    start, move, emit = total[:n], total[n : n + n * n].reshape(n, n), total[n + n * n :].reshape(s.width, n)
    base = (totals + 1) / (totals + 1).sum()
    start = start + 1
    move = move + 0.1
    emit = emit + s.prior * base[:, None]
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def score(docs: DataFrame, learn: Column, held: Column, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per input row.

    Learns from the rows for which ``learn`` holds.  Scores are log10
    probabilities: ``base_score`` under smoothed word counts, ``score`` under
    the hidden Markov model.  A null or empty text is one end.  Words never
    learned have count 0 and the share of an unseen word of their class.
    Repeated rows count and are returned each; a null key is like any other;
    further columns are ignored; very long texts are learned from and scored
    whole.  Without a row to learn from the base score
    is 0 and the states emit all classes alike; an empty table gives no rows.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions
    k = F.col(key).cast("bigint")
    rows = docs.select(
        F.pmod(F.xxhash64(k, F.col(text)), F.lit(s.spread * partitions)).cast("int").alias("block"),
        k.alias("k"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.coalesce(held, F.lit(False)).alias("held"),
        F.col(text).cast("binary").alias("t"),
    ).repartition(partitions, "block")
    counted = written(_counted(rows, partitions, buckets, s), "hmm-counts")
    vocab = vocabulary(counted, s)
    encoded = written(_encoded(rows, counted, vocab, buckets, s), "hmm-classes")
    learned = encoded.where("learn")
    model = first_model(vocab.totals, s)
    n = learned.count()
    if n:
        draw = F.pmod(F.xxhash64("k", F.lit(5)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, s.sample / n)) + 1
        sample = written(learned.where(draw).select("classes").repartition(4), "hmm-sample")
        for _ in range(s.warm):
            model = baum_welch(sample, model, vocab.totals, s)
        for _ in range(s.rounds):
            model = baum_welch(learned, model, vocab.totals, s)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def likelihood(classes: pa.Array) -> pa.Array:
        return pa.array(forward(shared.value, _sequences(classes), s.group), pa.float64())

    under = float(np.log10(vocab.tokens + vocab.distinct + 1))
    return encoded.select(
        F.col("k").alias(key),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(under)).alias("base_score"),
        (likelihood(F.col("classes")) + F.col("log_shares")).alias("score"),
    )
