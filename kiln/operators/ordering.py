"""Global order without a single-partition window.

Spark rows carry no order, so corpus order is an explicit key (``seq``).
Running totals over that key (X1) and exact quantiles (A3, A8) are computed
here with bounded per-task state:

* ``prefix_totals``: range-partition the narrow ``(key, values)`` rows, fix the
  layout with a stage table, total each partition (one row per
  partition), turn the totals into offsets, and add them to a running sum in
  a JVM window per range partition.  The offsets table is bounded by the
  partition count.
* ``exact_quantiles``: selection by digits.  A double's bits, put into an
  order-preserving form, are four digits of 16 bits; a pass counts one digit
  of the values that share the digits found so far.  Tasks hand over
  histograms of fixed size, so nothing is sorted, sketched or shuffled by
  value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import stage_table


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_totals(
    df: DataFrame,
    order_cols: Sequence[str],
    values: Mapping[str, Column],
    num_partitions: int | None = None,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, int]]:
    """``(order_cols, carry, one exclusive running total per value)`` and the grand totals.

    One pass serves any number of ``values``; ``order_cols`` must be unique.
    ``carry`` is for further narrow columns only: what is wide is joined back.
    """
    names = list(values)
    narrow = df.select(*order_cols, *carry, *[F.coalesce(v.cast("long"), F.lit(0)).alias(f"_v_{n}") for n, v in values.items()])
    placed = narrow.repartitionByRange(_partitions(df, num_partitions), *order_cols).withColumn("_p", F.spark_partition_id())
    ranged = stage_table(placed, "ranges", lean=True)
    totals = ranged.groupBy("_p").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_p", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names])
    grand = totals.agg(*[F.coalesce(F.sum(f"_t_{n}"), F.lit(0)).alias(n) for n in names]).first().asDict()
    running = Window.partitionBy("_p").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    # The broadcast side has one row per range partition.
    out = ranged.join(F.broadcast(offsets), "_p").select(
        *order_cols, *carry, *[(F.coalesce(F.sum(f"_v_{n}").over(running), F.lit(0)) + F.col(f"_o_{n}")).alias(n) for n in names]
    )
    return out, grand


def prefix_sums(df: DataFrame, order_col: str, value_col: str | None = None, num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``(order_col, cum_before)`` and the grand total of ``value_col`` (1 per row when ``None``)."""
    value = F.lit(1) if value_col is None else F.col(value_col)
    sums, total = prefix_totals(df, [order_col], {"cum_before": value}, num_partitions)
    return sums, total["cum_before"]


def with_prefix_sum(
    df: DataFrame, order_col: str, value_col: str | None = None, out_col: str = "cum_before", num_partitions: int | None = None
) -> tuple[DataFrame, int]:
    """``df`` plus the exclusive running total, joined back on the key; returns the total too."""
    sums, total = prefix_sums(df, order_col, value_col, num_partitions)
    return df.join(sums.withColumnRenamed("cum_before", out_col), order_col), total


def with_position(df: DataFrame, order_col: str, out_col: str = "position") -> DataFrame:
    """Dense 0-based position in ``order_col`` order (``zipWithIndex``)."""
    out, _ = with_prefix_sum(df, order_col, None, out_col)
    return out


_SIGN = np.uint64(1 << 63)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers in the same order (-0.0 equals 0.0; NaN is last)."""
    bits = (np.where(np.isnan(x), np.nan, x) + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def from_ordered_bits(bits: int) -> float:
    """The double of ``ordered_bits``."""
    raw = bits ^ (1 << 63) if bits >> 63 else ~bits & (1 << 64) - 1
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def digit_counts(vals: DataFrame, wanted: Mapping, shift: int) -> DataFrame:
    """``(g, prefix, digit, n)``: the 16 bits above ``shift`` of the values whose higher bits are a wanted prefix of their group."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {(g, p): np.zeros(1 << 16, np.int64) for g, prefixes in wanted.items() for p in prefixes}
        for frame in frames:
            groups = frame.column("g").dictionary_encode()
            names, of = groups.dictionary.to_pylist(), groups.indices.fill_null(len(groups.dictionary)).to_numpy(zero_copy_only=False)
            bits = ordered_bits(frame.column("x").to_numpy(zero_copy_only=False))
            for i, g in enumerate([*names, None]):
                own = bits[of == i] if len(wanted.get(g, ())) else bits[:0]
                higher = own >> np.uint64(shift + 16) if shift < 48 else np.zeros(len(own), np.uint64)
                digit = (own >> np.uint64(shift) & np.uint64(0xFFFF)).astype(np.int64)
                for p in wanted.get(g, ()):
                    total[g, p] += np.bincount(digit[higher == np.uint64(p)], minlength=1 << 16)
        for (g, p), n in total.items():
            at = np.flatnonzero(n)
            columns = {"g": pa.array([g] * len(at), pa.string()), "prefix": pa.array([str(p)] * len(at), pa.string()), "digit": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return vals.mapInArrow(count, "g string, prefix string, digit int, n bigint").groupBy("g", "prefix", "digit").agg(F.sum("n").alias("n"))


def exact_quantiles(df: DataFrame, group_col: str, value_col: str, probs: Sequence[tuple[str, float]]) -> DataFrame:
    """Per group: ``n, min, max, mean`` and each named linear-interpolated quantile.

    Matches ``numpy.percentile`` / ``statistics.median`` (rank ``p (n - 1)``).
    Nulls are ignored.  Groups are few (metrics, ratios): the driver holds a
    row and, in each of the four passes, histograms of at most 2**16 counts
    for each of a group's quantiles.  The passes read the persisted narrow
    values.
    """
    vals = df.select(F.col(group_col).cast("string").alias("g"), F.col(value_col).cast("double").alias("x")).where(F.col("x").isNotNull())
    vals = vals.persist(StorageLevel.MEMORY_AND_DISK)
    stats = vals.groupBy("g").agg(F.count("*").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean")).collect()
    ranks = {(r.g, k): (0, k) for r in stats for _, p in probs for k in (math.floor(p * (r.n - 1)), math.ceil(p * (r.n - 1)))}
    for shift in (48, 32, 16, 0):
        wanted: dict = {}
        for (g, _), (prefix, _) in ranks.items():
            wanted.setdefault(g, set()).add(prefix)
        found: dict = {}
        for r in digit_counts(vals, wanted, shift).collect():
            found.setdefault((r.g, int(r.prefix)), []).append((r.digit, r.n))
        for (g, k), (prefix, rest) in ranks.items():
            for digit, n in sorted(found[g, prefix]):
                if rest < n:
                    break
                rest -= n
            ranks[g, k] = (prefix << 16 | digit, rest)
    vals.unpersist()

    def at(g, n: int, p: float) -> float:
        rank = p * (n - 1)
        lo, hi = (from_ordered_bits(ranks[g, k][0]) for k in (math.floor(rank), math.ceil(rank)))
        return lo + (hi - lo) * (rank - math.floor(rank))

    rows = [(r.g, r.n, r.min, r.max, r.mean, *(at(r.g, r.n, p) for _, p in probs)) for r in stats]
    names = "".join(f", {name} double" for name, _ in probs)
    return df.sparkSession.createDataFrame(rows, f"{group_col} string, n bigint, min double, max double, mean double{names}")
