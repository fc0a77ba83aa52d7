"""Substring deduplication by super-k-mer partitioning.

A window is ``k`` consecutive words; its minimiser is the least hashed
``m``-gram of words in it.  Consecutive windows that share a minimiser form
a super-k-mer, which travels once, as one packed string of its words, to
the bucket of the minimiser.  Equal windows have equal minimisers, so all
occurrences of a window meet in one bucket, where sorting finds them.

1. Documents are dealt to blocks by a hash.  A block keeps each distinct
   super-k-mer once, with the least and the largest key that hold it, and
   packs those for one bucket into one compressed frame: a passage that a
   third of all documents share reaches its bucket once per block, not once
   per document.
2. A bucket sorts the windows of its distinct strings by hash, compares the
   words of equal hashes, and answers a block with the least keys of the
   windows of every string that some larger key of the block holds.
3. A block finds its super-k-mers anew (its texts are dealt once and read
   twice) and removes the words of windows whose least key is smaller than
   the document's.

Nothing is dropped, capped or sampled; a bucket's frames hold distinct text
per block, and buckets and blocks are many small ones.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import long_word_hashes, mix, powers, runs, trim, word_spans

NO_KEY = np.iinfo(np.int64).max

#: Words that one vectorised step handles; bounds the temporaries of a task.
STEP_WORDS = 1 << 17


@dataclass(frozen=True)
class Settings:
    """There are ``spread`` blocks and as many buckets per shuffle partition of the session.

    So what passes between blocks and buckets is a few rows per pair of tasks,
    as in any shuffle.  A task holds one block or the strings of one bucket at
    a time, and solves a bucket in ``parts`` by minimiser.  ``longest`` is the most
    windows of one super-k-mer (longer runs are parted, none is lost).
    """

    k: int = 13
    m: int = 3
    spread: int = 2
    parts: int = 4
    longest: int = 256
    level: int = 3


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values (doubling)."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def rolled(hashes: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for lo in range(0, n, STEP_WORDS):
        own = out[lo : lo + STEP_WORDS]
        for i in range(width):
            part = hashes[lo + i : lo + i + len(own)] * np.uint64(0x9E3779B97F4A7C15 + 2 * (i + salt))
            own += part ^ (part >> np.uint64(31))
        own[:] = mix(own)
    return out


def digests(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each run of words [first, last), as an (n, 2) array."""
    out = np.empty((len(first), 2), np.uint64)
    for column, p in enumerate(_P):
        prefix = np.zeros(len(hashes) + 1, np.uint64)
        for i in range(0, len(hashes), STEP_WORDS):  # their temporaries are several times the words
            prefix[i + 1 : i + 1 + STEP_WORDS] = mix(hashes[i : i + STEP_WORDS] + np.uint64(column + 1))
        prefix[1:] *= powers(p, len(hashes), keep=False)
        np.cumsum(prefix, out=prefix)
        back = powers(np.uint64(pow(int(p), -1, 1 << 64)), len(hashes) + 1, keep=False)
        out[:, column] = mix((prefix[last] - prefix[first]) * back[first] + (last - first).astype(np.uint64))
    return out


class Block:
    """The words and super-k-mers of some texts; words of a text stand with one space between."""

    def __init__(self, texts: list[bytes], s: Settings):
        parts = [b" ".join(t.split()) for t in texts]
        self.raw = b"\n".join(parts)
        data = np.frombuffer(self.raw, np.uint8)
        edge = np.cumsum([len(p) + 1 for p in parts])
        self.starts, self.ends = word_spans(data)
        self.row = np.searchsorted(edge, self.starts, "right")
        self.hashes = long_word_hashes(data, self.starts, self.ends)
        self.words = np.bincount(self.row, minlength=len(texts))
        self._cut(s)

    def _cut(self, s: Settings) -> None:
        """Strings: first window, number of windows, minimiser, row, digest."""
        n = len(self.hashes) - s.k + 1
        if n <= 0:
            self.first = self.count = np.zeros(0, np.int64)
            self.minimiser, self.digest = np.zeros(0, np.uint64), np.zeros((0, 2), np.uint64)
            return
        least = sliding_least(rolled(self.hashes, s.m, 0), s.k - s.m + 1)
        inside = self.row[:n] == self.row[s.k - 1 :]
        new = np.ones(n, bool)
        new[1:] = (least[1:] != least[:-1]) | (self.row[1:n] != self.row[: n - 1])
        at = np.flatnonzero(inside)
        run = np.cumsum(new)[at]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(at) else at
        first, count = at[starts], np.diff(np.append(starts, len(at)))
        if len(count) and count.max() > s.longest:
            parts = -(-count // s.longest)
            which = np.repeat(np.arange(len(count)), parts)
            within = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
            left = count[which] - within * s.longest
            first, count = first[which] + within * s.longest, np.minimum(s.longest, left)
        self.first, self.count = first, count
        self.minimiser = least[first]
        del least, inside, new, at, run
        self.digest = digests(self.hashes, first, first + count + s.k - 1)

    def string(self, i: int, k: int) -> bytes:
        return self.raw[self.starts[self.first[i]] : self.ends[self.first[i] + self.count[i] + k - 2]]


def _frame(strings: list[bytes], part: np.ndarray, least: np.ndarray, most: np.ndarray, level: int) -> bytes:
    import zstandard

    head = struct.pack("<I", len(strings)) + np.array([len(x) for x in strings], np.uint32).tobytes() + part.astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(head + least.tobytes() + (most - least).tobytes() + b"".join(strings))


def _unframe(frame: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(strings, part, least key, largest key)."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(frame)
    n = struct.unpack_from("<I", raw)[0]
    edge = 4 + 21 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64)])
    part = np.frombuffer(raw, np.uint8, n, 4 + 4 * n)
    least = np.frombuffer(raw, np.int64, n, 4 + 5 * n)
    most = least + np.frombuffer(raw, np.int64, n, 4 + 13 * n)
    edge = edge.tolist()
    return [raw[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)], part, least, most


def _asks(block: Block, keys: np.ndarray, buckets: int, s: Settings) -> Iterator[tuple[int, bytes]]:
    """(bucket, frame) of a block: each distinct string once, with its least and largest key."""
    if not len(block.first):
        return
    own = keys[block.row[block.first]]
    order = np.lexsort((own, block.digest[:, 1], block.digest[:, 0]))
    d = block.digest[order]
    new = np.ones(len(order), bool)
    new[1:] = (d[1:] != d[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    string, least, most = order[at], own[order[at]], own[order[np.append(at[1:], len(order)) - 1]]
    bucket = (block.minimiser[string] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    string, least, most, bucket = string[by], least[by], most[by], bucket[by]
    part = block.minimiser[string] // np.uint64(buckets) % np.uint64(s.parts)
    lo = block.starts[block.first[string]].tolist()
    hi = block.ends[block.first[string] + block.count[string] + s.k - 2].tolist()
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(bucket[a]), _frame([block.raw[x:y] for x, y in zip(lo[a:b], hi[a:b], strict=True)], part[a:b], least[a:b], most[a:b], s.level)


def least_holders(strings: list[bytes], keys: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, Block]:
    """For distinct packed strings: (first window of each, least key per window, their words)."""
    words = Block.__new__(Block)
    words.raw = b"\n".join(strings)
    data = np.frombuffer(words.raw, np.uint8)
    edge = np.cumsum([len(x) + 1 for x in strings])
    words.starts, words.ends = word_spans(data)
    words.row = np.searchsorted(edge, words.starts, "right")
    words.hashes = long_word_hashes(data, words.starts, words.ends)
    words.words = np.bincount(words.row, minlength=len(strings))
    begin = np.cumsum(words.words) - words.words
    windows = words.words - s.k + 1
    first = np.cumsum(windows) - windows
    of = np.repeat(np.arange(len(strings)), windows)
    at = begin[of] + np.arange(len(of)) - first[of]
    value = rolled(words.hashes, s.k, 7)[at]
    own = keys[of]
    order = np.lexsort((own, value))
    new = np.ones(len(order), bool)
    new[1:] = value[order][1:] != value[order][:-1]
    head = np.empty(len(order), np.int64)
    head[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    least = own[head]
    raw, starts, ends = words.raw, words.starts, words.ends
    text = lambda w: raw[starts[at[w]] : ends[at[w] + s.k - 1]]
    if any(text(w) != text(head[w]) for w in np.flatnonzero(head != np.arange(len(head))).tolist()):
        # two windows share a hash: the words themselves decide
        held: dict[bytes, int] = {}
        every = [text(w) for w in range(len(at))]
        for window, key in zip(every, own.tolist(), strict=True):
            held[window] = min(key, held.get(window, NO_KEY))
        least = np.array([held[window] for window in every], np.int64)
    return first, least, words


def _solve(bucket: list[tuple[int, bytes]], s: Settings) -> Iterator[tuple[int, bytes]]:
    """(block, answer): digests, numbers of windows and least keys of the strings that matter to the block."""
    import zstandard

    index: dict[bytes, int] = {}
    asked, parts = [], []
    for block, frame in bucket:
        strings, part, least, most = _unframe(frame)
        known = len(index)
        which = np.array([index.setdefault(x, len(index)) for x in strings])
        parts.append(part[np.unique(which, return_index=True)[1]][np.unique(which) >= known])
        asked.append((block, which, least, most))
    which, part = np.concatenate([a[1] for a in asked]), np.concatenate(parts)
    keys = np.full(len(index), NO_KEY, np.int64)
    np.minimum.at(keys, which, np.concatenate([a[2] for a in asked]))
    largest = np.full(len(index), np.iinfo(np.int64).min)
    np.maximum.at(largest, which, np.concatenate([a[3] for a in asked]))
    spelled = list(index)
    del index
    answers: dict[int, list] = {}
    for p in range(s.parts):
        own = np.flatnonzero(part == p)
        if not len(own):
            continue
        first, least, words = least_holders([spelled[i] for i in own.tolist()], keys[own], s)
        lowest = np.minimum.reduceat(least, first)
        end = np.append(first[1:], len(least))
        # strings that no holder loses a word of need no answer
        matter = np.flatnonzero(lowest < largest[own])
        place = np.full(len(part), -1, np.int64)
        place[own[matter]] = matter
        last = np.cumsum(words.words)
        digest = digests(words.hashes, last - words.words, last)
        for block, strings, _, most in asked:
            at = place[strings]
            told = at[(at >= 0) & (lowest[np.maximum(at, 0)] < most)]
            if len(told):
                size = (end - first)[told]
                spans = np.arange(size.sum()) + np.repeat(first[told] - (np.cumsum(size) - size), size)
                answers.setdefault(block, []).append((digest[told], size.astype(np.uint32), least[spans]))
    pack = zstandard.ZstdCompressor(level=s.level)
    for block, found in answers.items():
        digest, size, least = (np.concatenate(x) for x in zip(*found, strict=True))
        yield block, pack.compress(struct.pack("<I", len(size)) + digest.tobytes() + size.tobytes() + least.tobytes())


def _told(answers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(digests sorted by their first half, first least, end, least keys) of all answers to a block."""
    import zstandard

    digest, count, least = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for answer in answers:
        raw = zstandard.ZstdDecompressor().decompress(answer)
        n = struct.unpack_from("<I", raw)[0]
        digest.append(np.frombuffer(raw, np.uint64, 2 * n, 4).reshape(n, 2))
        count.append(np.frombuffer(raw, np.uint32, n, 4 + 16 * n))
        least.append(np.frombuffer(raw, np.int64, -1, 4 + 20 * n))
    digest, count, least = np.concatenate(digest), np.concatenate(count).astype(np.int64), np.concatenate(least)
    end = np.cumsum(count)
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    return digest[order], (end - count)[order], end[order], least


def removed(block: Block, keys: np.ndarray, answers: list[bytes], s: Settings) -> np.ndarray:
    """True for each word of the block that a window with a smaller holder covers."""
    cover = np.zeros(len(block.hashes) + 1, np.int64)
    digest, begin, _, least = _told(answers)
    if len(digest) and len(block.first):
        at = np.searchsorted(digest[:, 0], block.digest[:, 0])
        at = np.minimum(at, len(digest) - 1)
        step = np.flatnonzero((digest[at, 0] == block.digest[:, 0]) & (digest[at, 1] != block.digest[:, 1]))
        for i in step.tolist():  # equal first halves stand side by side
            while at[i] + 1 < len(digest) and digest[at[i] + 1, 0] == block.digest[i, 0] and digest[at[i], 1] != block.digest[i, 1]:
                at[i] += 1
        found = np.flatnonzero((digest[at] == block.digest).all(axis=1))
        count = block.count[found]
        of = np.repeat(np.arange(len(found)), count)
        within = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        window = block.first[found][of] + within
        smaller = least[begin[at[found]][of] + within] < keys[block.row[window]]
        cover += np.bincount(window[smaller], minlength=len(cover))
        cover -= np.bincount(window[smaller] + s.k, minlength=len(cover))
    return np.cumsum(cover)[:-1] > 0


def _keys(values: list) -> np.ndarray:
    return np.array([NO_KEY if v is None else v for v in values], np.int64)


def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    untouched: bool = False,
    settings: Settings | None = None,
) -> DataFrame:
    """(key, n_words, n_removed, kept, a struct ``carry`` of the carried columns): one row per input row.

    Each word covered by a window of ``k`` words that also starts in a
    document with a smaller key is removed; windows are judged on the input.
    ``kept`` are the other words joined by one space; with ``untouched`` a
    text that loses nothing is returned as it is.  A null or empty text has
    no word and ``kept`` is empty (null and untouched: null).  Rows with the same key never remove
    words from each other; a null key counts as larger than all others.
    Texts of fewer than ``k`` words stay whole.  Columns not named pass away;
    an empty table gives no rows.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = buckets = s.spread * partitions
    k = F.col(key).cast("bigint")
    rows = docs.select(
        F.pmod(F.xxhash64(k, F.col(text)), F.lit(blocks)).cast("int").alias("block"),
        k.alias("k"),
        F.col(text).cast("binary").alias("t"),
        *([F.struct(*(F.col(c) for c in carry)).alias("carry")] if carry else []),
    ).repartition(partitions, "block")

    asks = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("frame", pa.binary())])

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in runs((f.select(["block", "k", "t"]) for f in frames), 0):
            found = list(_asks(Block([r[2] or b"" for r in held], s), _keys([r[1] for r in held]), buckets, s))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([block] * len(found), pa.int32()), pa.array([f for _, f in found], pa.binary())],
                    schema=asks,
                )
            trim()

    answers = pa.schema([("block", pa.int32()), ("answer", pa.binary())])

    def answer(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in runs(frames, 0):
            for block, told in _solve([(r[1], r[2]) for r in held], s):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([told], pa.binary())], schema=answers)
            trim()

    # the same columns as below, so that both reads share one exchange
    asked = rows.sortWithinPartitions("block").mapInArrow(ask, "bucket int, block int, frame binary")
    told = asked.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(answer, "block int, answer binary")

    out_type = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
        + ([rows.schema["carry"]] if carry else [])
    )

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        raws = left.column("t").to_pylist()
        keys = _keys(left.column("k").to_pylist())
        block = Block([r or b"" for r in raws], s)
        gone = removed(block, keys, right.column("answer").to_pylist(), s)
        lost = np.bincount(block.row[gone], minlength=len(raws))
        edge = np.concatenate([[0], np.cumsum(block.words)])
        kept = []
        for i in range(len(raws)):
            a, b = edge[i], edge[i + 1]
            if untouched and not lost[i]:
                kept.append(raws[i])
            elif not lost[i]:
                kept.append(block.raw[block.starts[a] : block.ends[b - 1]] if b > a else b"")
            else:  # runs of kept words
                left_over = np.concatenate([[False], ~gone[a:b], [False]])
                turn = np.flatnonzero(left_over[1:] != left_over[:-1]) + a
                kept.append(b" ".join(block.raw[block.starts[x] : block.ends[y - 1]] for x, y in zip(turn[0::2].tolist(), turn[1::2].tolist(), strict=True)))
        columns = {
            "k": left.column("k"),
            "n_words": pa.array(block.words, pa.int64()),
            "n_removed": pa.array(lost, pa.int64()),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
        if carry:
            columns["carry"] = left.column("carry")
        trim()
        return pa.table(columns)

    done = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(apply, out_type)
    return done.select(F.col("k").alias(key), "n_words", "n_removed", "kept", *(["carry"] if carry else []))
