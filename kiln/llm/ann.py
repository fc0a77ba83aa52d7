"""Approximate nearest neighbours by multiprobe p-stable hashing.

A vector's unit form is hashed in each of ``tables`` tables by ``hashes``
Gaussian (2-stable) projections, floor((a.x + b) / width).  A query visits
its own bucket and then perturbed buckets in order of estimated success:
moving a coordinate by one costs the squared distance to that side, and a
heap lists the cheapest sets of moves.  Candidates of all tables are merged
and ranked by their exact cosine in double precision.

Equal vectors are one entry with the few smallest ids that can matter, so a
vector that a third of all rows share is hashed and compared once.  Buckets
and the probes that reach it are cut into parts of bounded size that meet each other;
only the best of a part leave it, never all pairs.  A query that finds fewer
than it could is compared with every row, in the same bounded parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import mix, written


@dataclass(frozen=True)
class Settings:
    """Six tables of four hashes and 64 probes keep recall above 0.9 even among vectors that hardly cluster."""

    k: int = 5
    tables: int = 6
    hashes: int = 4
    width: float = 1.0
    probes: int = 64
    part: int = 4_096
    seed: int = 3


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite components, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def entries(vectors: DataFrame, key: str, vector: str, s: Settings) -> DataFrame:
    """(g, v, ids, n): one row per distinct vector; g is its least id, ids the k + 1 smallest ones."""
    keep = s.k + 1
    rows = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    # salted first, so that a common vector's ids are cut down before they meet
    salted = Window.partitionBy("v", F.pmod(F.xxhash64("id"), F.lit(16))).orderBy("id")
    few = rows.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= keep)
    ids = F.slice(F.array_sort(F.collect_list("id")), 1, keep)
    return few.groupBy("v").agg(ids.alias("ids")).select(F.col("ids")[0].alias("g"), "v", "ids")


class Hashes:
    """The projections for vectors of one length."""

    def __init__(self, dim: int, s: Settings):
        rng = np.random.default_rng([s.seed, dim])
        self.s = s
        self.a = rng.normal(size=(dim, s.tables * s.hashes))
        self.b = rng.uniform(0, s.width, s.tables * s.hashes)
        self.salt = np.uint64(dim * 1_000_003)

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Projections of unit rows in bucket widths, (rows, tables, hashes)."""
        return ((unit @ self.a + self.b) / self.s.width).reshape(len(unit), self.s.tables, self.s.hashes)

    def names(self, table: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """64-bit name of each bucket (rows of ``cells``); tables and lengths never share one but by chance."""
        out = mix(table.astype(np.uint64) + self.salt)
        for j in range(cells.shape[1]):
            out = mix(out ^ (cells[:, j].astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (2**64 - 1))))
        return out.view(np.int64)


def perturbations(inside: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Sets of moves (coordinate, -1 or +1) in order of their summed squared distances; the empty set first.

    ``inside``: the position within its cell, 0 to 1, per coordinate.
    """
    moves = sorted([(x * x, j, -1) for j, x in enumerate(inside)] + [((1 - x) ** 2, j, 1) for j, x in enumerate(inside)])
    cost = [m[0] for m in moves]
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        coordinates = [moves[z][1] for z in chosen]
        if len(set(coordinates)) == len(coordinates):
            out.append([moves[z][1:] for z in chosen])
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return out


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector in a batch."""
    lengths = np.diff(np.asarray(column.offsets))
    values = column.values.to_numpy(zero_copy_only=False)
    start = np.asarray(column.offsets)[:-1]
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, values[start[rows][:, None] + np.arange(dim)]


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # against overflow and underflow of the squares
    x = x / scale
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _hashed(s: Settings, probing: bool):
    schema = pa.schema([("bucket", pa.int64()), ("g", pa.int64()), ("v", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64()))])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[int, Hashes] = {}
        for frame in (f.slice(i, 1_000) for f in frames for i in range(0, f.num_rows, 1_000)):
            for rows, matrix in _by_length(frame.column("v")):
                h = hashes.setdefault(matrix.shape[1], Hashes(matrix.shape[1], s))
                places = h.places(unit(matrix))
                cells = np.floor(places)
                own, table, cell = [], [], []
                for t in range(s.tables):
                    if not probing:
                        own.append(rows)
                        table.append(np.full(len(rows), t))
                        cell.append(cells[:, t])
                        continue
                    for i, row in enumerate(rows):
                        moved = []
                        for moves in perturbations(places[i, t] - cells[i, t], s.probes):
                            at = cells[i, t].copy()
                            for j, step in moves:
                                at[j] += step
                            moved.append(at)
                        own.append(np.full(len(moved), row))
                        table.append(np.full(len(moved), t))
                        cell.append(np.array(moved))
                own = np.concatenate(own)
                bucket = h.names(np.concatenate(table), np.concatenate(cell))
                picked = frame.select(["g", "v", "ids"]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *(c for c in picked.columns)], schema=schema)

    return run


def best_of(queries: np.ndarray, against: np.ndarray, g: np.ndarray, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, candidates, cosines) of the ``keep`` nearest candidates, ties to the smaller g."""
    q, c = unit(queries), unit(against)
    for lo in range(0, len(q), 256):
        rough = q[lo : lo + 256] @ c.T
        more = min(len(c), 2 * keep)
        near = np.argpartition(-rough, more - 1, axis=1)[:, :more] if more < len(c) else np.tile(np.arange(len(c)), (len(rough), 1))
        # candidates that tie with the last one taken are all looked at
        least = np.take_along_axis(rough, near, 1).min(axis=1)
        for i in range(len(rough)):
            pick = np.flatnonzero(rough[i] >= least[i] - 1e-12)
            exact = cosine(queries[lo + i], against[pick])
            order = np.lexsort((g[pick], -exact))[:keep]
            yield lo + i, pick[order], exact[order]


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Exact measure: dot product over the product of the norms, in double precision."""
    return np.einsum("ij,j->i", many, one) / (np.sqrt(np.einsum("ij,ij->i", many, many)) * np.sqrt(np.dot(one, one)))


def _met(left: DataFrame, right: DataFrame, s: Settings) -> DataFrame:
    """Best candidates of each query in each (bucket, part, turn): (q, ids, score)."""
    schema = pa.schema([("q", pa.int64()), ("g", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def compare(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out_q, out_c, out_s = [], [], []
        if rows.num_rows and asks.num_rows:
            v, qv = rows.column("v").combine_chunks(), asks.column("v").combine_chunks()
            g, q = rows.column("g").to_numpy(), asks.column("g").to_numpy()
            lengths = {m.shape[1]: (at, m) for at, m in _by_length(v)}
            for at, matrix in _by_length(qv):
                if matrix.shape[1] in lengths:
                    own, against = lengths[matrix.shape[1]]
                    for i, near, score in best_of(matrix, against, g[own], s.k + 1):
                        out_q.append(np.full(len(near), q[at[i]]))
                        out_c.append(own[near])
                        out_s.append(score)
        if not out_q:
            return schema.empty_table()
        c = np.concatenate(out_c)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(out_q)), pa.array(g[c]), rows.column("ids").combine_chunks().take(pa.array(c)), pa.array(np.concatenate(out_s))],
            schema=schema,
        )

    grouped = left.groupBy("bucket", "part", "turn").cogroup(right.groupBy("bucket", "part", "turn"))
    return grouped.applyInArrow(compare, "q bigint, g bigint, ids array<bigint>, score double")


def _parted(table: DataFrame, probes: DataFrame, vectors: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows and probes (bucket, g) of a bucket dealt to parts of about ``part`` each; every part of the rows meets every one of the probes."""
    count = lambda of, name: of.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / s.part).cast("int").alias(name))
    parts = count(table, "rows").join(count(probes, "asks"), "bucket")  # buckets that no probe reaches are left out
    dealt = lambda salt, of: F.pmod(F.xxhash64("g", F.lit(salt)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    rows = table.join(parts, "bucket").withColumn("part", dealt(1, "rows")).withColumn("turn", every("asks")).drop("rows", "asks")
    asks = probes.join(parts, "bucket").withColumn("turn", dealt(2, "asks")).withColumn("part", every("rows")).drop("rows", "asks")
    return rows, asks.join(vectors, "g")


def _top(found: DataFrame, s: Settings) -> DataFrame:
    """(q, top): the k + 1 nearest (score, id) of each query entry."""
    each = found.select("q", "score", F.explode("ids").alias("id")).groupBy("q", "id").agg(F.max("score").alias("score"))
    ranked = each.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= s.k + 1)
    return ranked.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("top"))


def nearest(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``queries`` holds.

    Vectors that are null or empty, hold null or non-finite components, or
    are all zero take no part, nor do rows without a key; vectors of another
    length are no candidates.  Rows with equal vectors are different
    candidates, nearest ties go to the smaller id, and a row is never its own
    candidate.  A repeated key counts once.  Further columns are ignored; an
    empty table gives no rows; a table of fewer candidates gives all.
    """
    s = settings or Settings()
    valid = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull())
    asked = valid.where(queries).select(F.col(key).cast("bigint").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    every = written(entries(vectors, key, vector, s), "ann-entries")
    # each query with the entry of its vector
    asks = written(asked.join(every.select("g", "v"), "v").select("query_id", F.col("g").alias("q")), "ann-queries")
    probing = every.join(asks.select(F.col("q").alias("g")).distinct(), "g", "left_semi")
    ddl = "bucket bigint, g bigint, v array<double>, ids array<bigint>"
    table = every.select("g", "v", "ids").mapInArrow(_hashed(s, False), ddl)
    probes = probing.select("g", "v", F.slice("ids", 1, 0).alias("ids")).mapInArrow(_hashed(s, True), ddl).select("bucket", "g")
    found = _met(*_parted(table, written(probes, "ann-probes"), probing.select("g", "v"), s), s)
    top = written(_top(found, s), "ann-top")

    most = every.groupBy(F.size("v").alias("dim")).agg(F.sum(F.size("ids")).alias("ids"))
    short = (
        probing.select("g", "v", F.size("v").alias("dim"))
        .join(most, "dim")
        .join(top.select(F.col("q").alias("g"), F.size("top").alias("have")), "g", "left")
        .where(F.coalesce("have", F.lit(0)) < F.least("ids", F.lit(s.k + 1)))
        .select("g", "v")
    )
    short = written(short, "ann-short")
    if short.limit(1).count():
        one = every.select(F.lit(0).cast("bigint").alias("bucket"), "g", "v", "ids")
        again = _top(_met(*_parted(one, short.select(F.lit(0).cast("bigint").alias("bucket"), "g"), short, s), s), s)
        top = top.join(again.select("q"), "q", "left_anti").unionByName(again)
    others = F.filter("top", lambda x: x["id"] != F.col("query_id"))
    return (
        asks.join(top, "q")
        .select("query_id", F.posexplode(F.slice(others, 1, s.k)).alias("place", "c"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("c.id").alias("vec_id"), F.col("c.score").alias("score"))
    )
