"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

DartMinHash: every element of a weighted set throws the same hashed darts
whatever set it is in.  Darts arrive in order of rank as a Poisson process
over the strips of weight [0,1), [1,2), [2,4), ...; a dart counts for a set
if its weight coordinate lies below the element's weight, and each dart hits
one of ``k`` coordinates.  The earliest dart per coordinate is the
signature; two sets agree on a coordinate with the probability of their
weighted Jaccard similarity.  A set needs only about ``k ln k + 2k`` darts,
however many elements it has: the rank up to which they are thrown is set
by its total weight, and doubled for the few sets that leave a coordinate
empty.

Classes are the connected components of verified links (similarity of the
word shingles of at least ``threshold``) among documents that share a band:

1. documents with the same word sequence are one node from the start;
2. every member of a bucket is compared with the bucket's leader only: its
   most central node, whose bands are the most shared.  A group of copies
   costs about as many comparisons as it has members;
3. the rest, exactly: in buckets that still hold several components, members
   outside the largest are compared with all others across components, in
   blocks of bounded size: a pair in its first common band only, the
   likeliest by signature first, on the whole shingle sets, until a member
   is linked to a component.  Only links leave a block; pairs within a
   component are never compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import batches, mix, row_words, trim, utf8, written
from kiln.llm.graph import components


@dataclass(frozen=True)
class Settings:
    """22 bands of 4 rows find a pair of similarity 0.8 with probability 0.99999.

    ``weights``: "binary" (a shingle weighs 1) or "count" (as often as it occurs).
    ``slack``: a pair is verified if its signatures agree on at least
    ``threshold - slack`` of the coordinates (0.2 is 4.7 standard deviations).
    """

    words: int = 5
    threshold: float = 0.8
    bands: int = 22
    rows: int = 4
    weights: str = "binary"
    slack: float = 0.2
    block: int = 2_000  # members on each side of a block, and
    block_bytes: int = 32 << 20  # their shingle sets
    seed: int = 11

    @property
    def k(self) -> int:
        return self.bands * self.rows


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` words of a row; a row with fewer words has one shingle of all."""
    count = np.bincount(rows, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    out_row = np.repeat(np.arange(n_rows), made)
    within = np.arange(len(out_row)) - np.repeat(np.concatenate([[0], np.cumsum(made)])[:-1], made)
    at = first[out_row] + within
    last = first[out_row] + count[out_row]
    total = np.zeros(len(at), np.uint64)
    for step in range(size):
        inside = at + step < last
        picked = words[np.minimum(at + step, max(len(words) - 1, 0))] if len(words) else np.zeros(len(at), np.uint64)
        turned = (picked ^ np.uint64(step + 1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * step)
        total += np.where(inside, turned ^ (turned >> np.uint64(29)), np.uint64(0))
    return mix(total), out_row


_UNIT = np.float64(2.0**-53)


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from 64 hashed bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def throw(elements: np.ndarray, weights: np.ndarray, until: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, ...]:
    """(element index, coordinate, rank, fingerprint) of the darts that count, up to rank ``until``."""
    found = []
    top = int(np.ceil(np.log2(max(1.0, float(weights.max(initial=1.0))))))
    for strip in range(top + 1):
        low, rate = (0.0, 1.0) if strip == 0 else (2.0 ** (strip - 1), 2.0 ** (strip - 1))
        index = np.flatnonzero(weights > low)
        rank = np.zeros(len(index))
        base = mix(elements[index] + np.uint64(0x51ED27 * (strip + 1) + seed))
        dart = 0
        while len(index):
            dart += 1
            bits = mix(base + np.uint64(0x2545F4914F6CDD1D * dart & (2**64 - 1)))
            rank = rank - np.log(_uniform(bits)) / rate
            alive = rank <= until[index]
            index, rank, base, bits = index[alive], rank[alive], base[alive], bits[alive]
            more = mix(bits ^ np.uint64(0xA5A5A5A5DEADBEEF))
            height = low + rate * _uniform(mix(more))
            hits = height < weights[index]
            found.append((index[hits], (more[hits] % np.uint64(k)).astype(np.int64), rank[hits], (more[hits] >> np.uint64(32)).astype(np.uint32)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signatures(elements: np.ndarray, weights: np.ndarray, rows: np.ndarray, n_rows: int, k: int, seed: int) -> np.ndarray:
    """(n_rows, k) fingerprints of the earliest dart per coordinate; rows without an element are zero."""
    out = np.zeros((n_rows, k), np.uint32)
    total = np.bincount(rows, weights=weights, minlength=n_rows)
    want = k * (np.log(k) + 2)
    until = want / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        pick = np.flatnonzero(todo[rows])
        best = np.full(n_rows * k, np.inf)
        mark = np.zeros(n_rows * k, np.uint32)
        for at in range(0, len(pick), 1 << 17):
            part = pick[at : at + (1 << 17)]
            which, coordinate, rank, print_ = throw(elements[part], weights[part], until[rows[part]], k, seed)
            cell = rows[part][which] * k + coordinate
            order = np.lexsort((print_, rank, cell))
            cell, rank, print_ = cell[order], rank[order], print_[order]
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]
            cell, rank, print_ = cell[first], rank[first], print_[first]
            better = (rank < best[cell]) | ((rank == best[cell]) & (print_ < mark[cell]))
            best[cell[better]], mark[cell[better]] = rank[better], print_[better]
        full = np.isfinite(best.reshape(n_rows, k)).all(axis=1) & todo
        out[full] = mark.reshape(n_rows, k)[full]
        todo &= ~full
        until[todo] *= 2
    return out


def weighted(elements: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (element, weight = count, row)."""
    order = np.lexsort((elements, rows))
    elements, rows = elements[order], rows[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (elements[1:] != elements[:-1])
    at = np.flatnonzero(first)
    return elements[at], np.diff(np.append(at, len(rows))).astype(float), rows[at]


def _sketched(s: Settings):
    schema = pa.schema([("k", pa.int64()), ("node", pa.binary()), ("sig", pa.binary()), ("n", pa.int64()), ("h", pa.int64())])

    def sketch(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 1, 1 << 20):
            offsets, data = utf8(frame.column(1))
            n = frame.num_rows
            made, rows = shingles(*row_words(offsets, data), n, s.words)
            edge = np.searchsorted(rows, np.arange(n + 1))
            if s.weights == "count":
                sig = signatures(*weighted(made, rows), n, s.k, s.seed)
            else:
                sig = signatures(made, np.ones(len(made)), rows, n, s.k, s.seed)
            nodes, sigs = [], []
            for i in range(n):
                own = made[edge[i] : edge[i + 1]]
                nodes.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                sigs.append(sig[i].tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary()), pa.array(np.diff(edge), pa.int64()), frame.column(2)], schema=schema)
        trim()

    return sketch


def _sets(s: Settings):
    """Sorted shingle hashes of a text (with their counts behind them for weights by count)."""
    schema = pa.schema([("node", pa.binary()), ("bag", pa.binary())])

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 1, 1 << 20):
            offsets, data = utf8(frame.column(1))
            n = frame.num_rows
            made, rows = shingles(*row_words(offsets, data), n, s.words)
            made, counts, rows = weighted(made, rows)
            edge = np.searchsorted(rows, np.arange(n + 1))
            bags = []
            for i in range(n):
                bag = made[edge[i] : edge[i + 1]].tobytes()
                bags.append(bag + counts[edge[i] : edge[i + 1]].astype(np.uint32).tobytes() if s.weights == "count" else bag)
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(bags, pa.binary())], schema=schema)

    return make


def similarity(one: bytes, two: bytes, counted: bool) -> float:
    """Weighted Jaccard similarity of two bags; binary ones are sorted 64-bit hashes."""
    if not counted:
        a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
        both = np.concatenate([a, b])
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        return common / (len(both) - common) if len(both) else 0.0
    n, m = len(one) // 12, len(two) // 12
    a, b = np.frombuffer(one, np.uint64, n), np.frombuffer(two, np.uint64, m)
    x, y = np.frombuffer(one, np.uint32, n, 8 * n).astype(float), np.frombuffer(two, np.uint32, m, 8 * m).astype(float)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    least = np.minimum(x[i], y[j]).sum()
    return float(least / (x.sum() + y.sum() - least)) if n + m else 0.0


def _agreement(k: int):
    @F.arrow_udf("double")
    def agree(one: pa.Array, two: pa.Array) -> pa.Array:
        n = len(one)
        a = np.frombuffer(b"".join(one.to_pylist()), np.uint32).reshape(n, k)
        b = np.frombuffer(b"".join(two.to_pylist()), np.uint32).reshape(n, k)
        return pa.array((a == b).mean(axis=1) if n else [], pa.float64())

    return agree


def _beside(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The pairs with ``column`` of both nodes, as ``column``_a and ``column``_b."""
    one = lambda c: values.select(F.col("node").alias(c), F.col(column).alias(f"{column}_{c}"))
    return pairs.join(one("a"), "a").join(one("b"), "b")


def likely(pairs: DataFrame, sigs: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    return _beside(pairs, sigs, "sig").where(_agreement(s.k)(F.col("sig_a"), F.col("sig_b")) >= s.threshold - s.slack).select("a", "b")


def verified(pairs: DataFrame, bags: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold."""
    counted = s.weights == "count"

    @F.arrow_udf("double")
    def jaccard(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([similarity(p, q, counted) for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.float64())

    return _beside(pairs, bags, "bag").where(jaccard(F.col("bag_a"), F.col("bag_b")) >= s.threshold).select("a", "b")


def _mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, band, node, c, n) of the buckets that hold more than one component."""
    labelled = members.select("bucket", "band", "node").join(labels, "node")
    several = labelled.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("bucket")
    return written(labelled.join(several, "bucket"), "near-mixed")


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central node.

    A node is the more central the more members its buckets have: what all
    copies derive from keeps its bands, and each copy loses some of its own.
    """
    weight = members.groupBy("node").agg(F.sum("held").alias("w"))
    ranked = members.join(weight, "node")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("w", "node")).alias("l")).select("bucket", F.col("l.node").alias("leader"))
    pairs = members.join(leaders, "bucket").where("node <> leader")
    return pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _cells(mixed: DataFrame, s: Settings) -> DataFrame:
    """Blocks (bucket, i, j): part i of the members outside the bucket's largest component against part j of all."""
    size = mixed.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    parts = lambda m, n: F.ceil(F.greatest(m / s.block, 8 * n / s.block_bytes)).cast("int")
    main = (
        size.groupBy("bucket")
        .agg(F.max(F.struct("m", "c", "n")).alias("top"), F.sum("m").alias("all_m"), F.sum("n").alias("all_n"))
        .select(
            "bucket",
            F.col("top.c").alias("main"),
            parts(F.col("all_m") - F.col("top.m"), F.col("all_n") - F.col("top.n")).alias("parts_i"),
            parts(F.col("all_m"), F.col("all_n")).alias("parts_j"),
        )
    )
    rows = mixed.join(main, "bucket").withColumn("h", F.xxhash64("node", F.lit(1)))
    side = lambda asks, i, j: ["bucket", "band", i, j, "node", "c", F.lit(asks).alias("asks"), (F.col("c") != F.col("main")).alias("outside")]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod("h", n).cast("int")
    asks = rows.where("c <> main").select(*side(True, place("parts_i").alias("i"), every("parts_j").alias("j")))
    return asks.unionByName(rows.select(*side(False, every("parts_i").alias("i"), place("parts_j").alias("j"))))


def contiguous(frames: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for frame in frames:
        if not frame.num_rows:
            continue
        change = np.zeros(frame.num_rows, bool)
        for key in keys:
            values = frame.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            if held and values[0] != held[-1].column(key)[held[-1].num_rows - 1].as_py():
                change[0] = True
        at = 0
        for cut in np.flatnonzero(change):
            if cut > at:
                held.append(frame.slice(at, cut - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(frame.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _block_links(mixed: DataFrame, own: DataFrame, s: Settings) -> DataFrame:
    """Verified links (a, b) across components, found block by block."""
    cells = _cells(mixed, s).join(own.select("node", "sig", "bag"), "node")
    cells = cells.select("bucket", "i", "j", "band", "node", "c", "asks", "outside", "sig", "bag")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    least, counted = (s.threshold - s.slack) * s.k, s.weights == "count"

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in contiguous(frames, ["bucket", "i", "j"]):
            asks = cell.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            if not asks.any() or asks.all():
                continue
            node, c, outside, bag = (cell.column(x).to_pylist() for x in ("node", "c", "outside", "bag"))
            band = cell.column("band")[0].as_py()
            sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), np.uint32).reshape(-1, s.k)
            rest = np.flatnonzero(~asks)
            against = sig[rest]
            out: list[tuple[bytes, bytes]] = []
            for q in np.flatnonzero(asks).tolist():
                same = against == sig[q]
                agree = same.sum(axis=1)
                # a pair is looked at in its first common band only
                earlier = same[:, : band * s.rows].reshape(len(rest), band, s.rows).all(axis=2).any(axis=1)
                likely = np.flatnonzero((agree >= least) & ~earlier)
                linked = {c[q]}
                for x in rest[likely[np.argsort(-agree[likely], kind="stable")]].tolist():
                    # two members outside the main component meet twice
                    if c[x] in linked or (outside[x] and node[q] > node[x]):
                        continue
                    if similarity(bag[q], bag[x], counted) >= s.threshold:
                        linked.add(c[x])
                        out.append((min(node[q], node[x]), max(node[q], node[x])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], schema=schema)

    keys = ["bucket", "i", "j"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a binary, b binary")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """(key, class_id, distinct_texts, text_hash, class_node): one row per input row.

    ``class_id`` is the least key of the document's class, ``distinct_texts``
    the number of different word sequences in it.  A text without a word
    (null, empty, separators only) is like no other: its class is its own key
    and has no distinct text.  A text of fewer than ``words`` words is one
    shingle.  Repeated rows and exact copies share a class; a null key is
    never the least one unless its class has no other.  ``text_hash`` (of the
    whole text) and ``class_node`` (one per class, null without a word) tell
    rows and classes apart where keys repeat or are null.  Further columns
    are ignored; an empty table gives no rows.
    """
    s = settings or Settings()
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    hashed = rows.withColumn("h", F.xxhash64("t"))
    sketch = written(hashed.mapInArrow(_sketched(s), "k bigint, node binary, sig binary, n bigint, h bigint"), "near-sketch")
    nodes = written(sketch.where("node is not null").groupBy("node").agg(F.first("sig").alias("sig"), F.max("n").alias("n"), F.min("k").alias("k")), "near-nodes")
    bands = (F.xxhash64(F.lit(b), F.substring(F.col("sig"), 4 * s.rows * b + 1, 4 * s.rows)) for b in range(s.bands))
    banded = nodes.select("node", F.posexplode(F.array(*bands)).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    members = written(banded.join(shared, "bucket"), "near-members")
    sharing = nodes.join(members.select("node").distinct(), "node", "left_semi")
    own = written(sharing.join(_texts_of(rows, sharing, s), "node"), "near-own")

    links = verified(likely(_leader_pairs(members), own, s), own, s)
    stars = components(links, "near-components")
    labels = own.select("node", "n").join(stars, "node", "left").select("node", "n", F.coalesce("component", "node").alias("c"))
    rest = written(_block_links(_mixed_buckets(members, labels), own, s), "near-links")
    joined = components(stars.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest), "near-components")

    classed = written(nodes.select("node", "k").join(joined, "node", "left").withColumn("c", F.coalesce("component", "node")).select("node", "k", "c"), "near-classed")
    least = classed.groupBy("c").agg(F.min("k").alias("class_id"), F.count(F.lit(1)).alias("distinct_texts"))
    # written: what reads the classes, often twice, would plan all of this each time
    by_node = written(classed.select("node", "c").join(least, "c").select("node", "c", "class_id", "distinct_texts"), "near-classes")
    return sketch.select("k", "node", "h").join(by_node, "node", "left").select(
        F.col("k").alias(key),
        F.when(F.col("node").isNull(), F.col("k")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("distinct_texts", F.lit(0).cast("bigint")).alias("distinct_texts"),
        F.col("h").alias("text_hash"),
        F.col("c").alias("class_node"),
    )


def _texts_of(rows: DataFrame, holders: DataFrame, s: Settings) -> DataFrame:
    """(node, bag) from the texts of the holders.

    A key may repeat with other texts, and a node's holders may have no key, so
    nodes are computed again from the rows that match and the right ones kept.
    """
    wanted = holders.select(F.col("k").alias("hk")).distinct()
    texts = rows.join(wanted, F.col("k").eqNullSafe(F.col("hk")), "left_semi").select("t")
    schema = pa.schema([("node", pa.binary()), ("t", pa.string())])

    def named(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, 0, 1 << 20):
            offsets, data = utf8(frame.column(0))
            n = frame.num_rows
            made, row = shingles(*row_words(offsets, data), n, s.words)
            edge = np.searchsorted(row, np.arange(n + 1))
            nodes = [hashlib.md5(made[edge[i] : edge[i + 1]].tobytes()).digest() if edge[i + 1] > edge[i] else None for i in range(n)]
            yield from _sets(s)(iter([pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), frame.column(0).cast(pa.string())], schema=schema)]))

    made = texts.mapInArrow(named, "node binary, bag binary").where("node is not null")
    return made.groupBy("node").agg(F.first("bag").alias("bag"))


def kept(docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: of each class one row, the least by key (null last) and text hash.

    Texts without a word are in no class and stay, once per key and text; those without a key all stay.
    """
    from pyspark.sql.window import Window

    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("__k"), F.col("text_hash").alias("__h"))
    least = classes.where("class_node is not null").groupBy("class_node").agg(F.min(order).alias("r")).select("r.__k", "r.__h", F.lit(True).alias("__one"))
    alone = classes.where("class_node is null").select(F.col(key).alias("__k"), F.col("text_hash").alias("__h"), F.col(key).isNotNull().alias("__one"))
    stay = least.unionByName(alone).distinct()
    marked = docs.withColumn("__h", F.xxhash64(F.col(text)))
    same: Column = marked[key].eqNullSafe(stay["__k"]) & (marked["__h"] == stay["__h"])
    found = marked.join(stay, same).select(*(marked[c] for c in marked.columns), stay["__one"])
    numbered = found.withColumn("__row", F.row_number().over(Window.partitionBy(key, "__h").orderBy(F.lit(0))))
    return numbered.where("__row = 1 or not __one").drop("__h", "__one", "__row")
