"""Benchmark decontamination by latent semantic retrieval.

Passages are overlapping windows of words of a document.  Their TF-IDF
vectors are kept on the terms that occur in the benchmark (others cannot
match an item), by document frequencies over the whole corpus.

1. ``latent_space``: a distributed randomised SVD (range finder with power
   iterations; tasks multiply their own passages, partial products are summed
   by term range) of the benchmark items and all passages of the corpus (their
   halves) gives the latent basis.
2. Every passage of the corpus is projected and compared by cosine with every
   item; those from ``cosine`` on are candidates, ``found_by`` cosine.
3. A second source finds what no cosine can, paraphrases whose telling words
   are gone: a leak holds ``paraphrase`` of an item's words, so it holds some
   of any large enough set of them.  Counted are the rarest ones; what only
   this source finds is ``found_by`` words.
4. A candidate is confirmed on the words: the longest common subsequence of
   the item and a stretch of one and a half times its length, over the item's
   length, for every stretch of the region.  From ``verbatim`` on it is a
   leak; from ``paraphrase`` on only if the item's answer (its own column, or
   the closing words) is there as well.

Items are searched in blocks of about the rank of their latent space.  One
pass over the corpus serves as many blocks as fit into ``room`` bytes of
broadcast; the driver holds the items of one pass at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import batches, row_words, trim, utf8, written

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
for _lo, _hi in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    _FOLD[_lo:_hi] = 0x20


@dataclass(frozen=True)
class Settings:
    """``block`` bounds the items (about) behind one latent space; ``room`` what a pass broadcasts."""

    bits: int = 22  # of the hash that names a term
    half: int = 32  # a passage is two halves; passages overlap by one
    rank: int = 128
    extra: int = 8
    power: int = 1
    block: int = 192
    room: int = 128 << 20
    cosine: float = 0.55
    verbatim: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.8
    rare: float = 0.2  # of an item's words that a candidate holds among the rarest
    shortest: int = 8  # items of fewer words must occur as they are
    seed: int = 5


@dataclass
class Block:
    """The latent space of some items of a pass."""

    first: int  # number of its first item in the pass
    row_of: np.ndarray  # term of the pass -> row of ``basis``, -1 for others
    basis: np.ndarray  # (terms, rank): idf times basis
    items: np.ndarray  # (rank, items): unit columns


@dataclass
class Space:
    """What one pass over the corpus looks for."""

    slot: np.ndarray  # bucket -> term of the pass, -1 for others
    blocks: list[Block]
    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    edge: np.ndarray  # term -> its first entry in ``holder`` and ``times``
    holder: np.ndarray  # items that have the term among their rarest words
    times: np.ndarray  # and how often
    least: np.ndarray  # of them that a leak of the item holds at least
    settings: Settings = field(default_factory=Settings)


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, rows) of lower-cased texts without punctuation."""
    import pyarrow.compute as pc

    return row_words(*utf8(pc.utf8_lower(column.cast(pa.string()))), _FOLD)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def halves(hashes: np.ndarray, rows: np.ndarray, n: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half of each word, row of each half, first word of each half) over the rows of a batch."""
    count = np.bincount(rows, minlength=n)
    first = np.cumsum(count) - count
    made = -(-count // s.half)
    base = np.cumsum(made) - made
    half = base[rows] + (np.arange(len(rows)) - first[rows]) // s.half
    half_row = np.repeat(np.arange(n), made)
    return half, half_row, first[half_row] + (np.arange(len(half_row)) - base[half_row]) * s.half


def half_terms(rows: np.ndarray, half_row: np.ndarray, first: np.ndarray, slot: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half, slot, occurrences), each pair once, in order; words outside the benchmark's terms are left out.

    Halves are short, so each is sorted as a line of a matrix.
    """
    size = np.minimum(first + s.half, np.searchsorted(rows, half_row, "right")) - first
    line = np.repeat(np.arange(len(first)), size)
    grid = np.full((len(first), s.half), -1, np.int32)
    grid[line, np.arange(len(slot)) - first[line]] = slot
    grid.sort(axis=1)
    new = np.ones(grid.shape, bool)
    np.not_equal(grid[:, 1:], grid[:, :-1], out=new[:, 1:])
    new = new.ravel()
    at = np.flatnonzero(new)
    term, times = grid.ravel()[at], np.diff(np.append(at, len(new)))
    inside = term >= 0
    return at[inside] // s.half, term[inside].astype(np.int64), times[inside]


def _slots(buckets: np.ndarray, s: Settings) -> np.ndarray:
    slot = np.full(1 << s.bits, -1, np.int32)
    slot[buckets] = np.arange(len(buckets))
    return slot


def told_halves(docs: DataFrame, text: str, buckets: np.ndarray, s: Settings) -> DataFrame:
    """``(ids, ends, seen)``, written: the distinct terms of every half of the corpus, some halves a row.

    Terms are told by their place in ``buckets``.  A task ends with a row that
    has ``seen``: how many of its documents hold each term, and how many there are (-1).
    """
    shared = docs.sparkSession.sparkContext.broadcast(_slots(buckets, s))

    def tell(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(len(buckets), np.int64), 0
        for frame in batches(frames, 0, 1 << 20):
            hashes, rows = folded(frame.column(0))
            documents += frame.num_rows
            _, half_row, first = halves(hashes, rows, frame.num_rows, s)
            where, term, _ = half_terms(rows, half_row, first, shared.value[_bucket(hashes, s.bits)], s)
            if not len(where):
                continue
            held = np.unique(half_row[where] << np.int64(32) | term) & np.int64((1 << 32) - 1)
            total += np.bincount(held, minlength=len(buckets))
            end = np.append(np.flatnonzero(where[1:] != where[:-1]) + 1, len(where))
            start = np.append(0, end[:-1])
            ids, ends = [], []
            for i in range(0, len(end), 1024):
                own = end[i : i + 1024]
                ids.append(term[start[i] : own[-1]].astype(np.int32).tobytes())
                ends.append((own - start[i]).astype(np.int32).tobytes())
            yield _told_row(ids, ends, [None] * len(ids))
        at = np.flatnonzero(total)
        yield _told_row([b""], [b""], [np.append(np.stack([at, total[at]]), [[-1], [documents]], axis=1).tobytes()])
        trim()

    return written(docs.select(text).mapInArrow(tell, "ids binary, ends binary, seen binary"), "leak-passages")


def _told_row(ids: list, ends: list, seen: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"ids": pa.array(ids, pa.binary()), "ends": pa.array(ends, pa.binary()), "seen": pa.array(seen, pa.binary())})


def document_frequencies(told: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """(documents that hold each of the terms, documents) over the whole corpus."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for raw in frame.column(0).to_pylist():
                at, n = np.frombuffer(raw, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"b": pa.array(at, pa.int32()), "n": pa.array(n, pa.int64())})

    counted = told.where("seen is not null").select("seen").mapInArrow(count, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    found = {r.b: r.n for r in counted.collect()}
    return np.array([found.get(b, 0) for b in range(terms)], np.int64), found.get(-1, 0)


def _numbers(column: pa.Array, kind: type) -> Iterator[np.ndarray]:
    """The numbers of each row of a binary column, as views of its buffer."""
    edge, data = utf8(column)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield data[a:b].view(kind)


def _passages(frames: Iterator[pa.RecordBatch], place: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, weights, sizes) of some halves, as unit rows on the terms that have a ``place``."""
    for frame in frames:
        for ids, ends in zip(_numbers(frame.column("ids"), np.int32), _numbers(frame.column("ends"), np.int32), strict=True):
            term, end = place[ids], ends
            half = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))[term >= 0]
            term = term[term >= 0]
            size = np.bincount(half, minlength=1)
            size = size[size > 0]
            if len(size):
                value = idf[term]
                value = value / np.repeat(np.sqrt(np.add.reduceat(value**2, np.cumsum(size) - size)), size)
                yield term, value.astype(np.float32).astype(np.float64), size


#: Terms of a block up to which its Gram matrix is summed, once for all products.
GRAM = 4096


def gram(told: DataFrame, place: np.ndarray, idf: np.ndarray) -> DataFrame:
    """``(c, v)``, written: the Gram matrix A'A of all passages as U + U', some rows of U from row ``c`` on.

    U is the upper triangle with half the diagonal; a task holds it packed, row
    by row, and adds the pairs of some halves at a time.
    """
    shared = told.sparkSession.sparkContext.broadcast((place, idf))
    terms = len(idf)
    lines = max(1, (1 << 16) // terms)
    row = np.arange(terms) * terms - np.arange(terms) * (np.arange(terms) + 1) // 2

    def multiply(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms * (terms + 1) // 2)
        for term, value, size in _passages(frames, *shared.value):
            _add_pairs(total, row, term, value, size)
        for c in range(0, terms, lines):
            part = np.zeros((min(lines, terms - c), terms))
            for i, own in enumerate(part, c):
                own[i:] = total[row[i] + i : row[i] + terms]
            part = part.ravel()
            at = np.flatnonzero(part)
            if len(at):
                yield _stripe(c, at.astype(np.int32).tobytes(), part[at].tobytes())
        del total
        trim()

    def _stripe(c: int, at: bytes | None, v: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "at": pa.array([at], pa.binary()), "v": pa.array([v], pa.binary())})

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(0)
        for frame in frames:
            for c, at, v in zip(frame.column("c").to_pylist(), _numbers(frame.column("at"), np.int32), _numbers(frame.column("v"), np.float64), strict=True):
                if c != now:
                    if now is not None:
                        yield _stripe(now, None, total.tobytes())
                    now, total = c, np.zeros(min(lines, terms - c) * terms)
                total[at] += v
        if now is not None:
            yield _stripe(now, None, total.tobytes())
        trim()

    schema = "c int, at binary, v binary"
    parts = told.select("ids", "ends").mapInArrow(multiply, schema).repartition("c").sortWithinPartitions("c")
    return written(parts.mapInArrow(add, schema).select("c", "v"), "leak-gram")


def _add_pairs(total: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray, size: np.ndarray) -> None:
    """Add the products of the weights of all pairs of terms of each passage, halved for a term with itself.

    The terms of a passage rise, so a pair stands in the upper triangle.
    """
    n = np.repeat(np.cumsum(size), size) - np.arange(len(term))  # from each entry on to the end of its passage
    left = np.repeat(np.arange(len(term)), n)
    right = left + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
    weight = value[left] * value[right]
    weight[left == right] /= 2
    np.add.at(total, row[term[left]] + term[right], weight)


def _products(rows: DataFrame, q: np.ndarray, place: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A'A Q over all passages, summed by ranges of terms; ``rows``: the passages, or their ``gram``."""
    shared = rows.sparkSession.sparkContext.broadcast((q, place, idf))
    terms, width = q.shape
    chunk = 1024

    def from_gram(frames: Iterator[pa.RecordBatch], q: np.ndarray, total: np.ndarray) -> None:
        for frame in frames:
            for c, part in zip(frame.column("c").to_pylist(), _numbers(frame.column("v"), np.float64), strict=True):
                part = part.reshape(-1, terms)
                total[c : c + len(part)] += part @ q
                total += part.T @ q[c : c + len(part)]

    def from_passages(frames: Iterator[pa.RecordBatch], q: np.ndarray, total: np.ndarray, place: np.ndarray, idf: np.ndarray) -> None:
        for slot, weight, size in _passages(frames, place, idf):
            end = np.cumsum(size)
            start = end - size
            # some passages at a time: their products are dense
            for a in range(0, len(end), 256):
                lo, hi = start[a], end[min(a + 256, len(end)) - 1]
                part = weight[lo:hi, None] * q[slot[lo:hi]]
                y = np.add.reduceat(part, start[a : a + 256] - lo, axis=0)
                back = np.repeat(y, size[a : a + 256], axis=0) * weight[lo:hi, None]
                order = np.argsort(slot[lo:hi], kind="stable")
                own = slot[lo:hi][order]
                cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                total[own[cut]] += np.add.reduceat(back[order], cut, axis=0)

    def multiply(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width))
        q, place, idf = shared.value
        if summed:
            from_gram(frames, q, total)
        else:
            from_passages(frames, q, total, place, idf)
        for c in range(0, terms, chunk):
            yield pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "v": pa.array([total[c : c + chunk].tobytes()], pa.binary())})
        trim()

    def add(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(v, np.float64) for v in table.column("v").to_pylist()]
        return pa.table({"c": table.column("c").slice(0, 1), "v": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})

    summed = "c" in rows.columns
    out = np.zeros((terms, width))
    for row in rows.mapInArrow(multiply, "c int, v binary").groupBy("c").applyInArrow(add, "c int, v binary").collect():
        out[row.c : row.c + chunk] = np.frombuffer(row.v, np.float64).reshape(-1, width)
    return out


def _passage_count(told: DataFrame, place: np.ndarray) -> int:
    """Passages that hold a term of the block."""
    shared = told.sparkSession.sparkContext.broadcast(place)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(size) for *_, size in _passages(frames, shared.value, np.ones(len(shared.value))))
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})
        trim()

    return told.select("ids", "ends").mapInArrow(count, "n bigint").agg(F.sum("n")).first()[0] or 0


def _item_rows(words: list[np.ndarray], slot: np.ndarray, idf: np.ndarray, s: Settings) -> np.ndarray:
    """Dense unit TF-IDF rows of the items (items x terms)."""
    out = np.zeros((len(words), len(idf)))
    for i, w in enumerate(words):
        own = np.unique(slot[_bucket(w, s.bits)])
        own = own[own >= 0]
        out[i, own] = idf[own]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def latent_space(told: DataFrame, terms: np.ndarray, words: list[np.ndarray], idf_of: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, idf times basis, unit columns of the items) by a randomised SVD over some items and all passages.

    ``told`` are the halves of the corpus on the ``terms`` of all items.  The
    products are taken from the passages' Gram matrix, which is summed once;
    if long items have more than ``GRAM`` terms, from the passages.
    """
    buckets = np.unique(np.concatenate([_bucket(w, s.bits) for w in words]))
    slot, idf = _slots(buckets, s), idf_of[buckets]
    place = slot[terms]
    rows = gram(told, place, idf) if len(buckets) <= GRAM else told.select("ids", "ends")
    a = _item_rows(words, slot, idf, s)
    # both sides weigh alike: the items' directions must not drown in the corpus'
    energy = max(1, _passage_count(told, place)) / len(words)
    rank = min(s.rank, len(buckets))
    q = np.random.default_rng(s.seed).normal(size=(len(buckets), min(rank + s.extra, len(buckets))))
    for _ in range(s.power + 1):
        q, _ = np.linalg.qr(_products(rows, q, place, idf) + energy * (a.T @ (a @ q)))
    small = q.T @ (_products(rows, q, place, idf) + energy * (a.T @ (a @ q)))
    value, vector = np.linalg.eigh((small + small.T) / 2)
    basis = q @ vector[:, np.argsort(-value)[:rank]]
    return buckets, (idf[:, None] * basis).astype(np.float32), unit_items(a, basis)


def unit_items(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The projected items as unit columns."""
    items = a @ basis
    items /= np.maximum(np.linalg.norm(items, axis=1, keepdims=True), 1e-12)
    return items.T.astype(np.float32)


def rare_words(words: list[np.ndarray], slot: np.ndarray, idf: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(edge, holder, times, least) of the rarest words of each item.

    A stretch with t of an item's n words lacks n - t of them, so of any n - t + k it holds k.
    """
    codes, least = [], []
    for i, w in enumerate(words):
        term = slot[_bucket(w, s.bits)].astype(np.int64)
        n = len(w)
        t = n if n < s.shortest else max(1, int(np.ceil(s.paraphrase * n - 1e-9)))
        k = min(t, max(1, int(s.rare * n)))
        rarest = np.lexsort((term, -idf[term]))[: n - t + k]
        codes.append(term[rarest] * len(words) + i)
        least.append(k)
    code, times = np.unique(np.concatenate(codes), return_counts=True)
    edge = np.searchsorted(code, np.arange(len(idf) + 1) * len(words))
    return edge, code % len(words), times, np.array(least)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over ``b``."""
    place: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        place[x] = place.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a.tolist():
        m = place.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def confirm(region: np.ndarray, item: np.ndarray, answer: np.ndarray, s: Settings) -> tuple[float, float, bool]:
    """(share of the item in order, share of the answer in order, leak) of the best stretch of the words around a candidate."""
    n = len(item)
    if n < s.shortest:
        at = np.flatnonzero(region[: len(region) - n + 1] == item[0]) if len(region) >= n else []
        whole = any((region[i : i + n] == item).all() for i in at)
        return float(whole), float(whole), whole
    # stretches of one and a half lengths: a subsequence spread over more is chance
    width = min(len(region), n + n // 2)
    own = np.sort(item)
    inside = np.concatenate([[0], np.cumsum(own[np.minimum(np.searchsorted(own, region), n - 1)] == region)])
    held = inside[width:] - inside[: len(inside) - width]
    need, close = int(np.ceil(s.paraphrase * n - 1e-9)), int(np.ceil(s.answer * len(answer) - 1e-9))
    best = (False, 0.0, 0.0)
    # a subsequence has no more words than the stretch has of the item
    starts = np.flatnonzero(held >= need)
    if not len(starts):
        return float(held.max() / n), 0.0, False
    at = 0
    while at < len(starts):
        first = int(starts[at])
        stretch = region[first : first + width]
        long = common_subsequence(stretch, item)
        told = common_subsequence(stretch, answer) if long >= need else 0
        leak = long >= s.verbatim * n - 1e-9 or long >= need and told >= close
        best = max(best, (leak, long / n, told / max(1, len(answer))))
        if long == n and leak:
            break
        # one word on, neither length changes by more than one
        lacks = max(need - long, min(close - told, int(np.ceil(s.verbatim * n - 1e-9)) - long) if long >= need and not leak else 0, 1)
        at = max(at + 1, int(np.searchsorted(starts, first + lacks)))
    return best[1], best[2], best[0]


def _cosines(where: np.ndarray, term: np.ndarray, half_row: np.ndarray, block: Block) -> np.ndarray:
    """(halves, items): cosine of the passage that starts at each half with each item."""
    own = block.row_of[term]
    mine = own >= 0
    where, own = where[mine], own[mine]
    n, rank = len(half_row), block.basis.shape[1]
    vector = np.zeros((n + 1, rank), np.float32)
    for lo in range(0, len(own), 1024):  # some terms at a time: their rows are dense
        at = where[lo : lo + 1024]
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        vector[at[cut]] += np.add.reduceat(block.basis[own[lo : lo + 1024]], cut, axis=0)
    joined = half_row[1:] == half_row[:-1]
    vector[: n - 1][joined] += vector[1:n][joined]
    norm = np.sqrt(np.einsum("ij,ij->i", vector[:n], vector[:n]))
    return (vector[:n] @ block.items) / np.maximum(norm, 1e-9)[:, None]


def _worded(where: np.ndarray, term: np.ndarray, times: np.ndarray, past: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """(half, item) from which on a stretch may hold enough of the item's rarest words."""
    size = space.edge[term + 1] - space.edge[term]
    at = np.repeat(space.edge[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    n = len(past)
    code = space.holder[at] * np.int64(n) + np.repeat(where, size)
    order = np.argsort(code, kind="stable")
    code = code[order]
    held = np.concatenate([[0], np.cumsum(np.minimum(space.times[at], np.repeat(times, size))[order])])
    cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else code
    item, half = code[cut] // n, code[cut] % n
    length = np.array([len(w) for w in space.words], np.int64)
    wide = -(-(length + length // 2 + space.settings.half - 1) // space.settings.half)
    end = np.minimum(half + wide[item], past[half])
    enough = held[np.searchsorted(code, item * n + end)] - held[cut] >= space.least[item]
    return half[enough], item[enough]


def _found(hashes: np.ndarray, rows: np.ndarray, n: int, space: Space) -> list[tuple[int, int, float, float, float, str]]:
    """(row, item, cosine, share, answer share, found by) of the confirmed leaks of a batch."""
    s = space.settings
    _, half_row, first = halves(hashes, rows, n, s)
    where, term, times = half_terms(rows, half_row, first, space.slot[_bucket(hashes, s.bits)], s)
    if not len(where):
        return []
    count = np.bincount(rows, minlength=n)
    begin = np.cumsum(count) - count
    past = np.searchsorted(half_row, half_row, "right")  # the half after a row's last
    near = [_cosines(where, term, half_row, b) for b in space.blocks]
    pairs = [np.nonzero(c >= s.cosine) for c in near]
    by_cosine = [(p, i + b.first) for (p, i), b in zip(pairs, space.blocks, strict=True)]
    by_words = _worded(where, term, times, past, space)
    part = np.concatenate([*(p for p, _ in by_cosine), by_words[0]])
    item = np.concatenate([*(i for _, i in by_cosine), by_words[1]])
    latent = np.arange(len(part)) < len(part) - len(by_words[0])
    # what lies around the candidates of one item in one row, joined where it overlaps
    length = np.array([len(w) for w in space.words], np.int64)[item]
    wide = length + length // 2
    row = half_row[part]
    lo = np.maximum(begin[row], first[part] - wide)
    hi = np.minimum(begin[row] + count[row], first[part] + np.maximum(2 * s.half, wide + s.half) + wide)
    order = np.lexsort((lo, row, item))
    out: dict[tuple[int, int], tuple] = {}
    i = 0
    starts, ends, of, to, by = (x[order].tolist() for x in (lo, hi, item, row, latent))
    while i < len(order):
        j, end, cosine = i + 1, ends[i], by[i]
        while j < len(order) and of[j] == of[i] and to[j] == to[i] and starts[j] <= end:
            end, cosine = max(end, ends[j]), cosine or by[j]
            j += 1
        share, told, leak = confirm(hashes[starts[i] : end], space.words[of[i]], space.answers[of[i]], s)
        if leak:
            b = next(b for b in reversed(range(len(space.blocks))) if space.blocks[b].first <= of[i])
            inside = slice(np.searchsorted(first, starts[i] - s.half, "right"), np.searchsorted(first, end))
            best = float(near[b][inside, of[i] - space.blocks[b].first].max())
            found = (best, share, told, "cosine" if cosine else "words")
            known = out.get((to[i], of[i]))
            out[to[i], of[i]] = found if known is None else (*(max(x, y) for x, y in zip(known[:3], found[:3], strict=True)), min(known[3], found[3]))
        i = j
    return [(r, k, *v) for (r, k), v in out.items()]


def text_hash(text: str) -> Column:
    """Tells the texts of rows with one key apart, in ``leaks``."""
    return F.xxhash64(text)


def passes(benchmark: DataFrame, rows: DataFrame, s: Settings) -> Iterator[Space]:
    """What each pass over the corpus looks for; ``benchmark``: (i, t, a, block), ``rows``: (t)."""

    def split(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            columns = [(h, np.searchsorted(at, np.arange(frame.num_rows + 1))) for h, at in (folded(frame.column(c)) for c in ("t", "a"))]
            for r, (i, block) in enumerate(zip(frame.column("i").to_pylist(), frame.column("block").to_pylist(), strict=True)):
                words, close = (h[cut[r] : cut[r + 1]] for h, cut in columns)
                if len(words):
                    close = close if len(close) else words[-max(3, len(words) // 4) :]
                    made = {"i": pa.array([i], pa.int64()), "block": pa.array([block], pa.int32()), "w": [words.tobytes()], "c": [close.tobytes()]}
                    yield pa.RecordBatch.from_pydict(made)

    told = written(benchmark.mapInArrow(split, "i bigint, block int, w binary, c binary"), "leak-items")

    def used(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield pa.RecordBatch.from_pydict({"b": pa.array(np.unique(_bucket(np.frombuffer(b"".join(frame.column("w").to_pylist()), np.uint64), s.bits)), pa.int32())})

    # at most 2**bits numbers
    buckets = np.array([r.b for r in told.select("w").mapInArrow(used, "b int").distinct().orderBy("b").collect()], np.int64)
    if not len(buckets):
        return
    corpus = told_halves(rows, "t", buckets, s)
    df, n = document_frequencies(corpus, len(buckets))
    idf = np.zeros(1 << s.bits)
    idf[buckets] = np.log((n + 1) / (df + 0.5)).clip(0.05)
    ids: list = []
    words: list[np.ndarray] = []
    answers: list[np.ndarray] = []
    made: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []

    def space() -> Space:
        terms = np.unique(np.concatenate([b for _, b, _, _ in made]))
        slot = _slots(terms, s)
        blocks = []
        for first, own, basis, items in made:
            row_of = np.full(len(terms), -1, np.int32)
            row_of[slot[own]] = np.arange(len(own))
            blocks.append(Block(first, row_of, basis, items))
        return Space(slot, blocks, ids, words, answers, *rare_words(words, slot, idf[terms], s), s)

    for block in sorted(r.block for r in told.select("block").distinct().collect()):
        own = told.where(F.col("block") == block).orderBy("i", "w").collect()
        new = [np.frombuffer(r.w, np.uint64) for r in own]
        if made and sum(x.nbytes for _, *m in made for x in m) >= s.room:
            yield space()
            ids, words, answers, made = [], [], [], []
        made.append((len(ids), *latent_space(corpus, buckets, new, idf, s)))
        ids += [r.i for r in own]
        words += new
        answers += [np.frombuffer(r.c, np.uint64) for r in own]
    yield space()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """(key, item, cosine, share, answer_share, found_by, text_hash): one row per leaked item of a document.

    ``share`` is the longest common subsequence over the item's words,
    ``answer_share`` the same for the answer (``answer`` column, else the last
    quarter of the item's words, three at least).  ``found_by`` is cosine if
    the latent search found the place, else words.  Null and empty texts and
    items without a word leak nothing; an empty table gives no rows; repeated
    rows and null keys give rows each, which ``text_hash`` tells apart; long
    documents and long items are searched whole; further columns are ignored.
    Items are compared as they are told by their text: equal items each get a
    row.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    schema = "k bigint, i bigint, cosine double, share double, answer_share double, found_by string, text_hash bigint"
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"), text_hash(text).alias("h"))
    result = spark.createDataFrame([], schema)
    told = benchmark.select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t"), (F.col(answer) if answer else F.lit(None)).cast("string").alias("a")).where("t is not null")
    blocks = max(1, -(-told.count() // s.block))
    for space in passes(told.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int")), rows, s):
        shared = spark.sparkContext.broadcast(space)

        def search(frames: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            space = shared.value
            for frame in batches(frames, 1, 1 << 20):
                found = _found(*folded(frame.column(1)), frame.num_rows, space)
                if found:
                    at = pa.array([f[0] for f in found])
                    columns = [frame.column(0).take(at), pa.array([space.ids[f[1]] for f in found], pa.int64())]
                    columns += [pa.array([f[c] for f in found], pa.float64() if c < 5 else pa.string()) for c in range(2, 6)]
                    yield pa.RecordBatch.from_arrays([*columns, frame.column(2).take(at)], names)
            trim()

        result = result.unionByName(rows.mapInArrow(search, schema))
    return result.withColumnsRenamed({"k": key, "i": item})
