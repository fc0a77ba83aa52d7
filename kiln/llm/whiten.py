"""Embedding whitening with block matrices.

1. Entries become integers (``floor(scale * c) + shift``); one pass sums them
   per dimension, so the mean is exact.
2. Centred rows are indexed into blocks: tasks cut their own rows into blocks
   of about ``block_bytes``, which are written once; a block's number is its
   place in its task plus the blocks of the tasks before.
3. The blocks form a tall ``BlockMatrix`` A (one column of blocks).  A'A, with
   the middle dimension split over as many tasks as A has, is the scatter; its
   local ``eigh`` gives the whitening matrix P.
4. A P projects the rows.  A result of one column of blocks would be dealt to
   the square root of the partitions only, so the same blocks are laid out as
   a square grid and multiplied by P repeated on the diagonal.

The driver holds a row of sums, the dimension squared, the number of tasks
and, as ``BlockMatrix`` does, the numbers of the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import written


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    shift: int = 1_000_000
    components: int = 32
    block_bytes: int = 2 << 20  # of a block of doubles


def _vectors(frame: pa.RecordBatch, s: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, integer entries) of the usable vectors of a batch, by dimension.

    Null and empty vectors and those with a null or non-finite entry are left out.
    """
    column = frame.column("v")
    entries = column.flatten()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = entries.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        x = values[first[rows][:, None] + np.arange(d)]
        good = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.floor(x[good] * s.scale)
        if x.size and not np.abs(x).max() < 2**52:
            raise OverflowError("an entry is too large for exact integers")
        yield d, rows[good], x.astype(np.int64) + s.shift


def totals(vectors: DataFrame, s: Settings) -> tuple[int, np.ndarray]:
    """(rows, sums per dimension) of the usable vectors of the commonest dimension (the larger of equals)."""

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for d, rows, x in _vectors(frame, s):
                own = sums.setdefault(d, np.zeros(d + 1, np.int64))
                own[0] += len(rows)
                own[1:] += x.sum(axis=0)
        for d, own in sums.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array(np.full(d + 1, d), pa.int32()), "i": pa.array(np.arange(d + 1), pa.int32()), "s": pa.array(own)})

    sums = written(vectors.select("v").mapInArrow(add, "d int, i int, s bigint").groupBy("d", "i").agg(F.sum("s").alias("s")), "whiten-sums")
    most = sums.where("i = 0 and s > 0").orderBy(F.desc("s"), F.desc("d")).first()
    if most is None:
        return 0, np.zeros(0, np.int64)
    found = {r.i: r.s for r in sums.where(F.col("d") == most.d).collect()}
    return int(most.s), np.array([found[i] for i in range(1, most.d + 1)], np.int64)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n * x - sums)**2, exact."""
    far = n * x - sums
    if not len(far):
        return np.zeros(0, np.int64)
    if float(np.abs(far).max()) ** 2 * far.shape[1] >= 2**62:
        wide = (far.astype(object) ** 2).sum(axis=1)
        if max(wide) >= 2**63:
            raise OverflowError("a deviation does not fit into a long")
        return wide.astype(np.int64)
    return (far**2).sum(axis=1)


def indexed(vectors: DataFrame, n: int, sums: np.ndarray, s: Settings) -> tuple[DataFrame, int]:
    """((block, keys, deviations, x), number of blocks): the usable rows, cut into numbered blocks."""
    spark = vectors.sparkSession
    d = len(sums)
    size = max(1, s.block_bytes // (8 * d))

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        keys, held = [], []

        def block(rows: int) -> pa.RecordBatch:
            nonlocal keys, held, no
            key, x = np.concatenate(keys), np.concatenate(held)
            keys, held = [key[rows:]], [x[rows:]]
            key, x = key[:rows], x[:rows]
            no += 1
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "no": pa.array([no - 1], pa.int64()),
                    "k": pa.array([pa.array(key, pa.int64(), from_pandas=False)], pa.list_(pa.int64())),
                    "deviation": pa.array([_deviation(x, n, sums)], pa.list_(pa.int64())),
                    "x": pa.array([x.tobytes()], pa.binary()),
                }
            )

        for frame in frames:
            own = np.array(frame.column("k").to_pylist(), object)
            for dim, rows, x in _vectors(frame, s):
                if dim == d:
                    keys.append(own[rows])
                    held.append(x)
                    while sum(map(len, keys)) >= size:
                        yield block(size)
        if sum(map(len, keys)):
            yield block(size)

    blocks = written(vectors.mapInArrow(cut, "part int, no bigint, k array<bigint>, deviation array<bigint>, x binary"), "whiten-blocks")
    ends, before, at = blocks.groupBy("part").agg((F.max("no") + 1).alias("n")).orderBy("part").collect(), [], 0
    for r in ends:
        before.append((r.part, at))
        at += r.n
    # one row per task of the pass before
    offsets = F.broadcast(spark.createDataFrame(before, "part int, before bigint"))
    return blocks.join(offsets, "part").select((F.col("before") + F.col("no")).alias("block"), "k", "deviation", "x"), at


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right with the middle dimension split over ``splits`` tasks per result block."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _matrix(values: np.ndarray) -> DenseMatrix:
    return DenseMatrix(*values.shape, np.asfortranarray(values).ravel(order="F"))


def whitening(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(P, share of the trace) of the leading components; directions without variance are left out."""
    value, vector = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    order = np.argsort(-value, kind="stable")[:components]
    value, vector = value[order], vector[:, order]
    real = value > len(scatter) * np.finfo(float).eps * max(float(value[0]), 0.0)
    trace = np.trace(scatter) / n
    return vector[:, real] / np.sqrt(value[real]), value[real] / trace if trace > 0 else value[real]


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component.

    Vectors that are null or empty, hold a null or non-finite entry, or differ
    from the commonest dimension (the larger of equally common ones) take no
    part.  Null keys and repeated rows are rows like any other; components are
    numbered by falling eigenvalue, ties in an order that is the same for all
    rows.  Directions without variance have no whitened value and are left
    out, so one vector, or equal vectors only, give no row, as does an empty
    table.  Further columns are ignored.  An entry beyond 2**52 / scale and a
    deviation beyond a long raise OverflowError.
    """
    s = settings or Settings()
    spark = embeddings.sparkSession
    schema = f"{key} bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors = embeddings.select(F.col(key).cast("bigint").alias("k"), F.col(vector).alias("v"))
    n, sums = totals(vectors, s)
    if not n:
        return spark.createDataFrame([], schema)
    d = len(sums)
    blocks, count = indexed(vectors, n, sums, s)
    size = max(1, s.block_bytes // (8 * d))

    def centred(x: bytes) -> DenseMatrix:
        return _matrix((n * np.frombuffer(x, np.int64).reshape(-1, d) - sums) / n)

    rows = blocks.select("block", "x").rdd
    side = math.isqrt(count - 1) + 1
    tall = BlockMatrix(rows.map(lambda r: ((r.block, 0), centred(r.x))), size, d, count * size, d).persist(StorageLevel.MEMORY_AND_DISK)
    splits = max(1, min(count, rows.getNumPartitions()))
    scatter = _times(tall.transpose(), tall, splits).toLocalMatrix().toArray()
    tall._java_matrix_wrapper.call("blocks").unpersist(False)
    p, explained = whitening(scatter, n, s.components)
    width = p.shape[1]
    if not width:
        return spark.createDataFrame([], schema)
    grid = BlockMatrix(rows.map(lambda r: ((r.block % side, r.block // side), centred(r.x))), size, d, side * size, side * d)
    copies = spark.sparkContext.parallelize(range(side), min(side, 8)).map(lambda j: ((j, j), _matrix(p)))
    projected = _times(grid, BlockMatrix(copies, d, width, side * d, side * width), 1).blocks
    flat = projected.map(lambda b: (b[0][0] + b[0][1] * side, bytearray(np.ascontiguousarray(b[1].toArray()).tobytes())))
    done = written(spark.createDataFrame(flat, "block bigint, w binary"), "whitened")

    def moments(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for frame in frames:
            for w in frame.column("w"):
                own = np.frombuffer(w.as_py()).reshape(-1, width)
                total[:-1] += own.T @ own
                total[-1] += own.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(total.size), pa.int32()), "v": pa.array(total.ravel())})

    found = done.select("w").mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.array([r.v for r in sorted(found, key=lambda r: r.i)]).reshape(width + 1, width) / n
    error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(width)).max())

    def told(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component = np.arange(1, width + 1, dtype=np.int32)
        for frame in frames:
            for k, deviation, w in zip(*(frame.column(c) for c in ("k", "deviation", "w")), strict=True):
                for i in range(0, len(k), 4096):
                    keys, far = k.values.slice(i, 4096), deviation.values.slice(i, 4096)
                    m = len(keys)
                    at = pa.array(np.repeat(np.arange(m), width))
                    yield pa.RecordBatch.from_pydict(
                        {
                            key: keys.take(at),
                            "component": pa.array(np.tile(component, m)),
                            "n": pa.array(np.full(m * width, n, np.int64)),
                            "deviation": far.take(at),
                            "whitened": pa.array(np.frombuffer(w.as_py()).reshape(-1, width)[i : i + m].ravel()),
                            "explained": pa.array(np.tile(explained, m)),
                            "identity_error": pa.array(np.full(m * width, error)),
                        }
                    )

    return blocks.select("block", "k", "deviation").join(done, "block").mapInArrow(told, schema)
