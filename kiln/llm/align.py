"""Alignment of two tokenizations by pointer jumping, with corpus-wide counts of linked pairs.

1. ``encoded``: tasks encode each whole text with both tokenizers.  A text is
   cut before spaces that follow a character that is no white space, where
   neither vocabulary can join anything; ids of such segments are kept in a
   bounded store of the worker, and missing ones come from the libraries.  A
   text whose segments do not give back its bytes is encoded whole.
2. Alignment: every token points to its farthest-right overlapping token of
   the other side (itself, for the right-hand one of two that end together);
   doubling all successors at once converges to the terminal token of each
   connected component, which labels its group.  The last tokens of a group
   end together: they are its link.
3. Links are counted where they arise: a block of some million links holds its
   distinct pairs once, with how often each occurs.  Only those meet in a
   shuffle, are summed over the corpus, and come back to their blocks.

A block bounds a task's memory; a text longer than a block is spread over
several, whose parts are summed at the end.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import batches, trim, written
from kiln.llm.tokens import PATTERN, UNSURE, _alphabet

#: Segments of " " + text: a cut stands before each space that follows a character that is no white space.
SEGMENT = re.compile(r"\s+\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+\Z")

_SHIFT = 20  # a pair is a << _SHIFT | b


@dataclass(frozen=True)
class Settings:
    piece: int = 1 << 19  # characters aligned at once
    store: int = 2_000_000  # tokens of segments that a worker keeps
    block: int = 1 << 17  # links of a block, about


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terminal of each A token, of each B token), as numbers of B tokens.

    The ends of two tokenizations of the same bytes, ascending, both up to the last byte.
    """
    if not len(end_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    na, nb = len(end_a), len(end_b)
    a_at = np.repeat(np.arange(na), np.diff(end_a, prepend=0))  # byte -> token
    b_at = np.repeat(np.arange(nb), np.diff(end_b, prepend=0))
    under = a_at[end_b - 1]
    to_a = end_a[under] > end_b
    to = np.concatenate([na + b_at[end_a - 1], np.where(to_a, under, na + np.arange(nb))])
    while True:
        on = to[to]
        if np.array_equal(on, to):
            return to[:na] - na, to[na:] - na
        to = on


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())), size


class Tokenizers:
    """Both tokenizers of a worker, their token bytes, and the store of segments."""

    def __init__(self, path_a: str, path_b: str, s: Settings):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        self.a, self.b, self.s = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b), s
        self.a.encode_special_tokens, self.model = True, self.a.model
        spec = json.loads(self.a.to_str())
        back = {c: b for b, c in _alphabet().items()}
        told = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(back[c] for c in t) if (t := told.get(i, "")) and all(c in back for c in t) else t.encode() for i in range(max(told) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        pre = spec["pre_tokenizer"] or {}
        #: neither side joins characters across a cut: byte-level pre-tokens take one leading space, and no piece holds a space after another character
        self.cuts = (
            spec["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and not pre["add_prefix_space"]
            and pre["use_regex"]
            and all(t["special"] for t in spec["added_tokens"])
            and self.b.id_to_piece(self.space) == "▁"
            and not any(re.search("[^▁]▁", p) for p in pieces)
        )
        self.len_a, self.len_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # each id as it stands in the list of groups: before another of its side, and as the last
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.shown = [b"%d," % i for i in range(na)] + [b"%d|" % i for i in range(na)] + [b"%d," % i for i in range(nb)] + [b"%d;" % i for i in range(nb)]
        self.fast = self._same_merges(spec) if self.cuts else None
        self.segments: list[str] = []
        self.clear(np.zeros(0, np.int64))

    def _same_merges(self, spec: dict):
        """A quicker encoder of the first side, if it can be shown to give the same ids; else None.

        It joins neighbours whenever they spell a token, whatever merge made
        that token.  While both have merged alike, a token's bytes stand in
        two parts only just before the merge that completes it; so if the
        merges of each token's own bytes lead to that token, the two never
        part.
        """
        import tiktoken

        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        vocab, back = spec["model"]["vocab"], {c: b for b, c in _alphabet().items()}
        added = {t["content"] for t in spec["added_tokens"]}
        single = {c for c in vocab if len(c) == 1 and c in back}
        if len(single) != 256 or len(set(merged)) != len(merged) or set(vocab) - added != single | set(merged):
            return None
        if any([t.id for t in self.model.tokenize(m)] != [vocab[m]] for m in merged):
            return None
        ranks = {bytes([b]): b for b in range(256)} | {bytes(back[c] for c in m): 256 + i for i, m in enumerate(merged)}
        self.id_of_rank = np.array([vocab[c] for c, _ in sorted(back.items(), key=lambda x: x[1])] + [vocab[m] for m in merged], np.int64)
        return tiktoken.Encoding("first side", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def clear(self, keep: np.ndarray) -> None:
        """Empty the store but for some slots; slots given out before are void."""
        ids = [self.tokens(keep, side) for side in (0, 1)] if len(keep) else [(np.zeros(0, np.int64),) * 2] * 2
        self.good = array("b", [self.good[i] for i in keep.tolist()])
        self.segments = [self.segments[i] for i in keep.tolist()]
        self.known = {t: i for i, t in enumerate(self.segments)}
        self.first = tuple(array("q", (np.cumsum(n) - n).tobytes()) for _, n in ids)
        self.size = tuple(array("i", n.astype(np.int32).tobytes()) for _, n in ids)
        self.ids = tuple(array("i", flat.astype(np.int32).tobytes()) for flat, _ in ids)
        self.used = np.zeros(len(self.segments), np.int64)

    def bound(self) -> None:
        """Leave in a full store those segments that came most often since it was last full, up to a half."""
        if len(self.ids[0]) + len(self.ids[1]) > self.s.store:
            used = np.pad(self.used, (0, len(self.segments) - len(self.used)))
            order = np.argsort(-used, kind="stable")
            order = order[used[order] > 1]
            size = sum(np.frombuffer(n, np.int32).astype(np.int64) for n in self.size)[order]
            self.clear(np.sort(order[np.cumsum(size) <= self.s.store // 2]))

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """(ids, ids of each text) of both sides of texts that start with the added space."""
        b = [[self.space] if t == " " else own for t, own in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1), strict=True)]
        return self.encode_a(texts), _flat(b)

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.fast is not None:
            # one text of all, cut again where its segments were joined
            joined = "".join(texts)
            if not UNSURE.search(joined) and not any(t[-1].isspace() for t in texts):
                ids = self.id_of_rank[np.array(self.fast.encode_ordinary(joined), np.int64)]
                upto = np.concatenate([[0], np.cumsum(self.len_a[ids])])
                ends = np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
                at = np.searchsorted(upto, ends)
                if np.array_equal(upto[np.minimum(at, len(ids))], ends):
                    return ids, np.diff(at, prepend=0)
            elif len(texts) > 1:
                half = len(texts) // 2
                (x, n), (y, m) = self.encode_a(texts[:half]), self.encode_a(texts[half:])
                return np.concatenate([x, y]), np.concatenate([n, m])
        return _flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])

    def fits(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw

    def all_fit(self, texts: list[str], both: tuple[tuple[np.ndarray, np.ndarray], ...]) -> list[bool]:
        """Which texts their tokens give back; all at once where all do."""
        raw = [t.encode() for t in texts]
        want, ends = b"".join(raw), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        for (ids, n), shown, length in zip(both, (self.bytes_a, self.bytes_b), (self.len_a, self.len_b), strict=True):
            upto = np.concatenate([[0], np.cumsum(length[ids])])
            if not np.array_equal(upto[np.cumsum(n)], ends) or b"".join(map(shown.__getitem__, ids.tolist())) != want:
                lists = [np.split(ids, np.cumsum(n)[:-1]) for ids, n in both]
                return [self.fits(t, a.tolist(), b.tolist()) for t, a, b in zip(texts, *lists, strict=True)]
        return [True] * len(texts)

    def slots(self, segments: list[str]) -> np.ndarray:
        known = self.known
        found = np.fromiter(map(known.get, segments, repeat(-1)), np.int64, len(segments))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = list(dict.fromkeys(segments[i] for i in missing))
            for i in range(0, len(new), 4096):
                part = new[i : i + 4096]
                both = self.encode(part)
                self.good.extend(self.all_fit(part, both))
                known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))
                self.segments += part
                for side, (ids, size) in enumerate(both):
                    self.first[side].frombytes((len(self.ids[side]) + np.cumsum(size) - size).tobytes())
                    self.size[side].frombytes(size.astype(np.int32).tobytes())
                    self.ids[side].frombytes(ids.astype(np.int32).tobytes())
            found[missing] = [known[segments[i]] for i in missing]
        more = np.bincount(found, minlength=len(self.used))
        more[: len(self.used)] += self.used
        self.used = more
        return found

    def sound(self, slots: np.ndarray) -> bool:
        return bool(np.frombuffer(self.good, np.int8)[slots].all())

    def tokens(self, slots: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the segments' tokens, tokens of each segment)."""
        first = np.frombuffer(self.first[side], np.int64)[slots]
        size = np.frombuffer(self.size[side], np.int32)[slots].astype(np.int64)
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.frombuffer(self.ids[side], np.int32)[at].astype(np.int64), size

    def pieces(self, text: str) -> Iterator[tuple[list[str], bool]]:
        """(segments, last) of the pieces of " " + text; a piece ends at a cut."""
        text, at = " " + text, 0
        while at < len(text):
            cut = min(len(text), at + self.s.piece)
            while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
                cut += 1
            yield SEGMENT.findall(text, at, cut), cut == len(text)
            at = cut


@dataclass
class Aligned:
    """Texts or parts of texts whose tokens were aligned together."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    told: list[bytes]  # the groups, each with ";" behind it
    links: np.ndarray


def align(t: Tokenizers, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Aligned:
    """Groups and links of consecutive texts: their ids one after the other, and how many each has."""
    end_a, end_b = np.cumsum(t.len_a[a]), np.cumsum(t.len_b[b])
    of_a, of_b = terminals(end_a, end_b)
    last = np.flatnonzero(of_b == np.arange(len(b)))  # the terminals, a group each
    group = np.zeros(len(b), np.int64)
    group[last] = np.arange(len(last))
    of_a, of_b = group[of_a], group[of_b]
    in_a, in_b = np.bincount(of_a, minlength=len(last)), np.bincount(of_b, minlength=len(last))
    last_a = np.cumsum(in_a) - 1
    before = np.cumsum(in_a + in_b) - (in_a + in_b)
    told = np.empty(len(a) + len(b), np.int64)
    ids, vocab = a.copy(), len(t.len_a)
    ids[last_a] += vocab
    told[before[of_a] + np.arange(len(a)) - (last_a - in_a + 1)[of_a]] = ids
    ids = b + 2 * vocab
    ids[last] += len(t.len_b)
    told[(before + in_a)[of_b] + np.arange(len(b)) - (last - in_b + 1)[of_b]] = ids
    ends = np.cumsum(n_a + n_b).tolist()
    groups = np.diff(np.searchsorted(last, np.cumsum(n_b), "left"), prepend=0)
    shown, words, start = t.shown.__getitem__, told.tolist(), 0
    strings = []
    for end in ends:
        strings.append(b"".join(map(shown, words[start:end])))
        start = end
    return Aligned(n_a, n_b, groups, strings, a[last_a] << _SHIFT | b[last])


def aligned(t: Tokenizers, texts: list[str | None]) -> Iterator[tuple[list[int], Aligned, bool]]:
    """(numbers of texts, their alignment, whether they end there): short texts together, long ones piece by piece."""

    def together(slots: list[np.ndarray]) -> Aligned:
        edge = np.cumsum([0] + [len(own) for own in slots])[:-1]
        (a, size_a), (b, size_b) = (t.tokens(np.concatenate(slots), side) for side in (0, 1))
        return align(t, a, b, np.add.reduceat(size_a, edge), np.add.reduceat(size_b, edge))

    def whole(text: str) -> Aligned:
        (a, n_a), (b, n_b) = t.encode([" " + text])
        return align(t, a, b, n_a, n_b) if t.fits(" " + text, a.tolist(), b.tolist()) else none

    zero = np.zeros(1, np.int64)
    none = Aligned(zero, zero, zero, [b""], zero[:0])
    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        long = bool(text) and len(text) >= t.s.piece
        if held and (long or size >= t.s.piece):
            yield numbers, together(held), True
            numbers, held, size = [], [], 0
        if not held:
            t.bound()
        if not text:
            yield [i], none, True
        elif not t.cuts:
            yield [i], whole(text), True
        elif long:
            good = True
            for segments, _ in t.pieces(text):
                good = good and t.sound(t.slots(segments))
                t.bound()
            if not good:
                yield [i], whole(text), True
                continue
            for segments, last in t.pieces(text):
                yield [i], together([t.slots(segments)]), last
                t.bound()
        else:
            slots = t.slots(SEGMENT.findall(" " + text))
            if t.sound(slots):
                numbers.append(i)
                held.append(slots)
                size += len(text)
            else:
                yield [i], whole(text), True
    if held:
        yield numbers, together(held), True


_WORKER: dict[tuple, Tokenizers] = {}

_BLOCK = (
    "block bigint, row array<bigint>, k array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "sha array<string>, ends array<bigint>, at binary, pairs binary, times binary"
)


def encoded(docs: DataFrame, path_a: str, path_b: str, s: Settings) -> DataFrame:
    """Blocks of texts (or parts of one): counts and digest per row, distinct linked pairs, and the pair of each link."""

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path_a, path_b, s)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Tokenizers(path_a, path_b, s)
            trim()
        t = _WORKER[key]
        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        links: list[np.ndarray] = []
        n_links = blocks = seen = 0

        def block() -> pa.RecordBatch:
            nonlocal rows, links, n_links, blocks
            flat = np.concatenate([np.zeros(0, np.int64), *links])
            pairs, at, times = np.unique(flat, return_inverse=True, return_counts=True)
            columns = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([base + blocks], pa.int64()),
                    **{c: pa.array([list(v)], pa.list_(pa.string() if c == "sha" else pa.int64())) for c, v in zip(("row", "k", "n_a", "n_b", "n_groups", "sha", "ends"), columns, strict=True)},
                    "at": pa.array([at.astype(np.uint16 if len(pairs) <= 1 << 16 else np.int32).tobytes()], pa.binary()),
                    "pairs": pa.array([pairs.tobytes()], pa.binary()),
                    "times": pa.array([times.astype(np.int64).tobytes()], pa.binary()),
                }
            )
            rows, links, n_links, blocks = [], [], 0, blocks + 1
            return out

        open_hash = None  # of a long text
        for frame in batches(frames, 1, s.piece):
            keys = frame.column(0).to_pylist()
            for numbers, made, last in aligned(t, frame.column(1).to_pylist()):
                counts = zip(numbers, made.n_a.tolist(), made.n_b.tolist(), made.n_groups.tolist(), made.told, strict=True)
                end = n_links
                for i, n_a, n_b, groups, told in counts:
                    if not last or open_hash:
                        held = open_hash or hashlib.sha256()
                        held.update(b";" + told[:-1] if open_hash else told[:-1])
                        open_hash = None if last else held
                        sha = held.hexdigest() if last else None
                    else:
                        sha = hashlib.sha256(told[:-1]).hexdigest() if told else ""
                    end += groups
                    rows.append((base + seen + i, keys[i], n_a, n_b, groups, sha, end))
                links.append(made.links)
                n_links = end
                if n_links >= s.block or len(rows) >= s.block:
                    yield block()
            seen += frame.num_rows
        if rows:
            yield block()
        trim()

    return written(docs.mapInArrow(make, _BLOCK), "aligned")


def _spread(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, block, times) of each block, some rows at a time.

    All texts have been encoded, so a worker that still holds its tokenizers hands their memory back.
    """
    if _WORKER:
        _WORKER.clear()
        gc.collect()
        trim()
    for frame in frames:
        for block, pairs, times in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            p, n = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.int64)
            for i in range(0, len(p), 1 << 16):
                part = p[i : i + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"pair": pa.array(part), "block": pa.array(np.full(len(part), block), pa.int64()), "n": pa.array(n[i : i + (1 << 16)])})


def alignment(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per input row.

    ``tokenizer_a`` is a byte-level file of ``tokenizers``, ``tokenizer_b`` a
    model of ``sentencepiece`` that adds a leading space.  Null and empty
    texts and those that a tokenizer does not give back byte by byte have
    zeros and an empty digest.  Repeated rows and null keys get rows of their
    own and count each time; ties for a pair's highest count all count as
    best; an empty table gives no rows; long texts are aligned piece by piece,
    whole; further columns are ignored.  A run of text without a space is
    encoded in one go.
    """
    s = settings or Settings()
    blocks = encoded(docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t")), tokenizer_a, tokenizer_b, s)
    pairs = blocks.select("block", "pairs", "times").mapInArrow(_spread, "pair bigint, block bigint, n bigint")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    side = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    counts = written(counts, "pair-counts")
    # a row per id of the second vocabulary
    best = F.broadcast(counts.groupBy(side.alias("b")).agg(F.max("count").alias("most")))
    rated = counts.join(best, side == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    known = pairs.select("pair", "block").join(rated, "pair")

    def rate(own: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told.column("pair").to_numpy())
        count, top = told.column("count").to_numpy()[order], told.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        (row,) = own.drop_columns(["block"]).to_pylist()
        at = np.frombuffer(row["at"], np.uint16 if len(row["at"]) == 2 * row["ends"][-1] else np.int32)
        upto = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[at])])[row["ends"]], prepend=0)
        columns = {c: pa.array(row[c], pa.string() if c == "sha" else pa.int64()) for c in ("row", "k", "n_a", "n_b", "n_groups", "sha")}
        return pa.table(columns | {"n_best": pa.array(upto(top), pa.int64()), "count_sum": pa.array(upto(count), pa.int64())})

    schema = "row bigint, k bigint, n_a bigint, n_b bigint, n_groups bigint, sha string, n_best bigint, count_sum bigint"
    parts = blocks.drop("pairs", "times").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(rate, schema)
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")]
    whole = parts.groupBy("row").agg(F.max("k").alias(key), *sums, F.max("sha").alias("groups_sha256"))
    return whole.select(key, "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
