"""T4/T5: exact greedy BPE training in phases over the distinct pretokens.

Greedy training merges the most frequent pair, over and over (ties: smaller
ids).  A job per merge would be mostly latency, so a phase does many:

1. Count the weighted adjacent pairs (summed in the tasks, then by key) and
   take the most frequent ones, the *hot* pairs: all with a count from a
   threshold on.
2. Cut every word into its hot runs (stretches of symbols whose neighbours
   are hot pairs) and add up equal runs.  There are few distinct ones; if they
   are more than ``runs``, the threshold is raised.
3. Merge greedily inside the runs on the driver as long as the best count is
   at least the threshold.  This is what greedy training of all words does: a
   merge lowers counts or makes pairs that are no more frequent than the pair
   they come from, so no pair that reaches the threshold has an occurrence
   outside the runs.  (A merge that spells a token known already adds to
   pairs that may stand elsewhere, so it ends the phase.)
4. Replace the runs in the words by what became of them, in one pass that
   touches only the words that hold one; a word of one symbol is done.

What the driver and the broadcasts hold is bounded by ``hot`` and ``runs``: the
ranking is cut and the runs are counted in the tasks, and what the driver gets
of them comes compressed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import stage_table

WORDS = "cnt bigint, sym array<int>"
_PAIR = np.int64(32)


@dataclass(frozen=True)
class Phases:
    """``hot`` bounds the hot pairs of a phase (first, at most), ``runs`` their distinct runs."""

    first: int = 64
    hot: int = 50_000
    runs: int = 200_000


@dataclass
class Learned:
    """Tokens by id, and merges in rank order."""

    tokens: list[bytes]
    index: dict[bytes, int]
    merges: list[tuple[int, int, int]] = field(default_factory=list)
    phases: int = 0

    def fits(self, a: int, b: int, below: int) -> bool:
        return len(self.tokens[a]) + len(self.tokens[b]) < below

    def merge(self, a: int, b: int) -> tuple[int, bool]:
        """(id of the merged token, whether it was known)."""
        text = self.tokens[a] + self.tokens[b]
        known = text in self.index
        if not known:
            self.index[text] = len(self.tokens)
            self.tokens.append(text)
        self.merges.append((a, b, self.index[text]))
        return self.index[text], known


def word_symbols(counts: DataFrame, byte_ids: list[int]) -> DataFrame:
    """``(cnt, sym)`` of the words ``(word, cnt)`` of two bytes and more."""
    ids = np.array(byte_ids, np.int32)

    def spell(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            words = frame.column("word").cast(pa.large_binary())
            offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
            raw = np.frombuffer(words.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0])
            yield _frame(frame.column("cnt").to_numpy(zero_copy_only=False), np.diff(offsets), ids[raw])

    return counts.select("word", "cnt").where(F.octet_length("word") > 1).mapInArrow(spell, WORDS)


def _frame(cnt: np.ndarray, size: np.ndarray, flat: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(cnt, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))], ["cnt", "sym"])


def _arrays(frame: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, number of symbols, flat symbols) of a batch of words."""
    sym = frame.column("sym")
    size = np.diff(sym.offsets.to_numpy())
    return frame.column("cnt").to_numpy(zero_copy_only=False), size, sym.flatten().to_numpy(zero_copy_only=False)


def _neighbours(size: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair key at each position, whether a neighbour in the same word follows)."""
    key = np.zeros(len(flat), np.int64)
    key[:-1] = flat[:-1].astype(np.int64) << _PAIR | flat[1:]
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(size) - 1] = False
    return key, inside


#: Words that a task handles at once: equal pairs and runs of many words are summed and looked up once.
WIDE = 100_000


def _wide(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, several put together up to about ``WIDE`` words."""
    held, rows = [], 0
    for frame in frames:
        held.append(frame)
        rows += frame.num_rows
        if rows >= WIDE:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class Sums:
    """Counts summed by key; what is held is at most twice the distinct keys and some."""

    def __init__(self, key: str, kind: pa.DataType):
        self.sum = pa.table({key: pa.array([], kind), "c": pa.array([], pa.int64())})
        self.key, self.new, self.rows = key, [], 0

    @property
    def distinct(self) -> int:
        return self.sum.num_rows

    def add(self, keys: pa.Array, counts: np.ndarray) -> None:
        self.new.append(pa.table({self.key: keys, "c": pa.array(counts, pa.int64())}))
        self.rows += len(keys)
        if self.rows > max(1 << 20, self.sum.num_rows):
            self._meet()

    def _meet(self) -> None:
        met = pa.concat_tables([self.sum, *self.new]).group_by(self.key, use_threads=False).aggregate([("c", "sum")])
        self.sum, self.new, self.rows = met.select([self.key, "c_sum"]).rename_columns([self.key, "c"]), [], 0

    def told(self) -> pa.RecordBatch:
        self._meet()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in self.sum.columns], [self.key, "c"])


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each stretch of ``n``, one stretch after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _cut(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The symbols of each stretch as bytes."""
    n = end - start
    offsets = np.concatenate([[0], np.cumsum(4 * n)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(flat[_spread(start, n)])])


def pair_counts(words: DataFrame, lengths: np.ndarray, below: int) -> DataFrame:
    """``(pair, c)`` of the pairs whose token would have fewer than ``below`` bytes."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sums("pair", pa.int64())
        for frame in _wide(frames):
            cnt, size, flat = _arrays(frame)
            if not len(flat):
                continue
            key, inside = _neighbours(size, flat)
            inside[:-1] &= lengths[flat[:-1]] + lengths[flat[1:]] < below
            total.add(pa.array(key[inside]), np.repeat(cnt, size)[inside])
        yield total.told()

    return words.mapInArrow(count, "pair bigint, c bigint").groupBy("pair").agg(F.sum("c").alias("c"))


def _runs(size: np.ndarray, flat: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first symbol, end) of each hot run; ``hot`` is sorted."""
    if not len(flat) or not len(hot):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, inside = _neighbours(size, flat)
    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
    warm = np.concatenate([[False], inside & (hot[at] == key), [False]])
    turn = np.flatnonzero(warm[1:] != warm[:-1])
    return turn[0::2], turn[1::2] + 1


def hot_runs(words: DataFrame, hot: np.ndarray) -> DataFrame:
    """``(run, c)``: the distinct hot runs with the summed counts of their words."""
    shared = words.sparkSession.sparkContext.broadcast(hot)

    def project(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Sums("run", pa.binary())
        for frame in _wide(frames):
            cnt, size, flat = _arrays(frame)
            start, end = _runs(size, flat, shared.value)
            total.add(_cut(flat, start, end), np.repeat(cnt, size)[start])
            if total.distinct > 1 << 20:  # a task's memory stays bounded; equal runs meet in the sum
                yield total.told()
                total = Sums("run", pa.binary())
        yield total.told()

    return words.mapInArrow(project, "run binary, c bigint").groupBy("run").agg(F.sum("c").alias("c"))


def replace_runs(words: DataFrame, hot: np.ndarray, became: dict[bytes, np.ndarray]) -> DataFrame:
    """The words with each changed run replaced; words of one symbol are left out."""
    shared = words.sparkSession.sparkContext.broadcast((hot, became))

    def apply(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, told = shared.value
        for frame in _wide(frames):
            cnt, size, flat = _arrays(frame)
            start, end = _runs(size, flat, pairs)
            runs = _cut(flat, start, end).dictionary_encode()
            found = [told.get(r) for r in runs.dictionary.to_pylist()]  # equal runs of a batch are looked up once
            which = runs.indices.to_numpy(zero_copy_only=False)
            changed = np.array([f is not None for f in found], bool)[which]
            if changed.any():
                start, end, which = start[changed], end[changed], which[changed]
                each = np.array([0 if f is None else len(f) for f in found])
                first, n = (np.cumsum(each) - each)[which], each[which]
                gone = np.zeros(len(flat) + 1, np.int64)
                np.add.at(gone, start + n, 1)
                np.add.at(gone, end, -1)
                keep = np.cumsum(gone)[:-1] == 0
                flat = flat.copy()
                flat[_spread(start, n)] = np.concatenate([f for f in found if f is not None])[_spread(first, n)]
                size = np.add.reduceat(keep.astype(np.int64), np.cumsum(size) - size)
                flat = flat[keep]
            long = size > 1
            yield _frame(cnt[long], size[long], flat[np.repeat(long, size)])

    return words.mapInArrow(apply, WORDS)


def gathered(df: DataFrame) -> pa.Table:
    """The rows of a small table on the driver, in order; tasks send them compressed."""

    def pack(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, frame.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(frame)
            yield pa.RecordBatch.from_pydict({"rows": pa.array([out.getvalue().to_pybytes()], pa.binary())})

    parts = [pa.ipc.open_stream(r.rows).read_all() for r in df.mapInArrow(pack, "rows binary").collect()]
    return pa.concat_tables(parts) if parts else pa.table({c: [] for c in df.columns})


class Hot(NamedTuple):
    pair: int
    c: int


def ranking(counts: DataFrame, size: int) -> list[Hot]:
    """The ``size`` most frequent pairs (ties: smaller ids); the tasks' own rankings meet in a task, not on the driver."""
    told = gathered(counts.orderBy(F.desc("c"), "pair").limit(size))
    return sorted((Hot(*x) for x in zip(told["pair"].to_pylist(), told["c"].to_pylist(), strict=True)), key=lambda r: (-r.c, r.pair))


def merged(run: list[int], a: int, b: int, new: int) -> list[int]:
    """Every (a, b) of a run replaced, from left to right."""
    out, i, last = [], 0, len(run) - 1
    while i <= last:
        if i < last and run[i] == a and run[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(run[i])
            i += 1
    return out


def merge_runs(runs: list[list[int]], counts: list[int], learned: Learned, least: int, below: int, vocab_size: int, only: set | None = None) -> None:
    """Greedy merges inside weighted runs (changed in place) while the best pair counts ``least``.

    ``only`` restricts the merges to some pairs, once each.  A merge that spells a known token is the last.
    """
    total: dict[tuple[int, int], int] = {}
    where: dict[tuple[int, int], set[int]] = {}

    def add(i: int, sign: int, touched: set) -> None:
        run = runs[i]
        for pair in zip(run[:-1], run[1:], strict=True):
            total[pair] = total.get(pair, 0) + sign * counts[i]
            touched.add(pair)
            if sign > 0:
                where.setdefault(pair, set()).add(i)

    pairs: set[tuple[int, int]] = set()
    for i in range(len(runs)):
        add(i, 1, pairs)
    may = lambda p: learned.fits(*p, below) if only is None else p in only
    heap = [(-total[p], *p) for p in pairs if may(p)]
    heapq.heapify(heap)
    while heap and len(learned.tokens) < vocab_size:
        count, a, b = heapq.heappop(heap)
        now = total.get((a, b), 0)
        if now != -count:
            if now >= least:
                heapq.heappush(heap, (-now, a, b))
            continue
        if now < least:
            return
        new, known = learned.merge(a, b)
        touched: set[tuple[int, int]] = set()
        for i in where.pop((a, b)):
            after = merged(runs[i], a, b, new)
            if len(after) < len(runs[i]):
                add(i, -1, touched)
                runs[i] = after
                add(i, 1, touched)
        total[a, b] = 0
        if known:
            return
        for p in touched:
            if p != (a, b) and total[p] >= least and new in p and may(p):
                heapq.heappush(heap, (-total[p], *p))


def _disjoint(top: list) -> set[tuple[int, int]]:
    """The longest beginning of a ranking whose pairs share no symbol: their merges do not touch each other's counts."""
    used: set[int] = set()
    out = set()
    for pair in (divmod(r.pair, 1 << 32) for r in top):
        if used & set(pair):
            break
        out.add(pair)
        used |= set(pair)
    return out


def learn(words: DataFrame, learned: Learned, vocab_size: int, min_frequency: int, most_bytes: int, p: Phases = Phases()) -> None:
    """Merge up to ``vocab_size`` tokens or until no pair counts ``min_frequency``; ``words``: (cnt, sym).

    Tokens stay below ``most_bytes``, but two single bytes may always join (as the public trainer has it).
    """
    size, below = p.first, max(most_bytes, 3) if most_bytes > 1 else 0
    while len(learned.tokens) < vocab_size:
        lengths = np.array([len(t) for t in learned.tokens], np.int32)
        top = ranking(pair_counts(words, lengths, below).where(F.col("c") >= min_frequency), size + 1)
        if not top:
            return
        only, least = None, min_frequency
        if len(top) > size:  # all pairs above the count of the first one left out
            least = top[size].c + 1
            top = [r for r in top[:size] if r.c >= least] or top[:size]
            if top[0].c < least:
                if size < p.hot:
                    size = min(p.hot, 4 * size)
                    continue
                least, only = top[0].c, _disjoint(top)  # more equal counts than a phase holds
                top = [r for r in top if divmod(r.pair, 1 << 32) in only]
        while True:
            hot = np.sort(np.array([r.pair for r in top], np.int64))
            told = hot_runs(words, hot).persist()
            # the runs of a single pair are as many as they have lengths
            found = gathered(told) if told.count() <= p.runs or len(top) == 1 else None
            told.unpersist()
            if found is not None:
                break
            # fewer hot pairs have fewer runs; equal counts stay together, or pairs without a symbol in common
            size = max(1, len(top) // 4)
            least, fewer = top[size].c + 1, top[:size]
            top = [r for r in fewer if r.c >= least]
            if not top:
                least, only = fewer[0].c, _disjoint(fewer)
                top = [r for r in fewer if divmod(r.pair, 1 << 32) in only]
        before = [np.frombuffer(r, np.int32) for r in found["run"].to_pylist()]
        runs = [x.tolist() for x in before]
        merge_runs(runs, found["c"].to_pylist(), learned, least, below, vocab_size, only)
        became = {x.tobytes(): np.array(y, np.int32) for x, y in zip(before, runs, strict=True) if len(x) != len(y)}
        words = stage_table(replace_runs(words, hot, became), "bpe-words")
        learned.phases += 1
        if len(found) < p.runs // 8:
            size = min(p.hot, 2 * size)
