"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``cap`` (how often it is taken).
Among all rates that meet each source's token target, the ones nearest to
"take everything once" in Fermi-Dirac entropy are exponentially tilted::

    rate(x) = cap / (1 + (cap - 1) * exp(-lambda_s * x)),   x = size / mean size of the source

One multiplier per source is left.  The dual is convex and separable, so
Newton steps on ``lambda_s`` (kept inside a shrinking bracket) converge in a
few rounds.  Each round is one aggregation over the histogram
(source, size, number of documents), which tasks pre-aggregate; sums are
exact decimals, so reruns agree to the last bit.

Rates are then rounded into whole copies: cells of equal (source, size) are
walked from the largest size down, each taking the number of copies that
brings the words taken so far nearest to the words due so far, so a source
ends within about one small document of its target.  A cell's copies are
dealt to its documents in an order given by a hash of the key; cells of many
documents are first split into salted parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kiln.llm.common import WORD, written


@dataclass(frozen=True)
class Settings:
    """``weights`` repeat over the sources in code point order, null last."""

    weights: Sequence[float] = (5, 2, 1)
    share: float = 1.5
    cap: int = 2
    tolerance: float = 1e-9
    rounds: int = 40
    steps: int = 3  # Newton steps in one job
    part: int = 10_000  # documents of a cell that one window orders


def word_count(text: str) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(sizes: DataFrame, s: Settings) -> DataFrame:
    """(sid, source, source_size, n, target) per source; ``sizes``: (source, source_size, n).

    Targets share ``share`` of all sizes by weight; none is above ``cap``
    times its source, and what a capped one leaves goes to the others by
    weight.  Ordered by cap / weight, the capped sources are a prefix, and
    the level of the rest follows from sums before and after it.
    """
    weights = F.array(*(F.lit(float(w)) for w in s.weights))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    named = (
        sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("w", F.element_at(weights, (F.col("sid") % len(s.weights) + 1).cast("int")))
        .withColumn("most", s.cap * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("most") / F.col("w"))
    )
    level = (F.lit(s.share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    levelled = named.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))).over(everything)
    return levelled.withColumn("target", F.least("most", F.coalesce(first["level"] * F.col("w"), F.col("most")))).select(
        "sid", "source", "source_size", "n", "target"
    )


def _rate(lam: Column, x: Column, cap: int) -> Column:
    return F.lit(float(cap)) / (1 + F.lit(float(cap - 1)) * F.exp(-lam * x))


def _exact(term: Column) -> Column:
    return F.sum(term.cast("decimal(38,9)")).cast("double")


def _step(histogram: DataFrame, state: DataFrame, s: Settings) -> DataFrame:
    """One Newton step of every source that has not converged, kept inside its bracket."""
    x = F.col("size") / F.col("mean")
    rate = _rate(F.col("lam"), x, s.cap)
    words = F.col("n") * F.col("size") * rate
    sums = (
        histogram.join(state.where("not done").select("sid", "mean", "lam"), "sid")
        .groupBy("sid")
        .agg(_exact(words).alias("f"), _exact(words * x * (1 - rate / s.cap)).alias("slope"))
    )
    miss = F.col("f") - F.col("target")
    moved = (
        state.join(sums, "sid", "left")
        .withColumn("nlo", F.when(miss < 0, F.col("lam")).otherwise(F.col("lo")))
        .withColumn("nhi", F.when(miss > 0, F.col("lam")).otherwise(F.col("hi")))
    )
    step = F.col("lam") - miss / F.nullif(F.col("slope"), F.lit(0.0))
    inside = (
        step.isNotNull()
        & (F.abs(step - F.col("lam")) <= 4)
        & (F.col("nlo").isNull() | (step > F.col("nlo")))
        & (F.col("nhi").isNull() | (step < F.col("nhi")))
    )
    middle = F.when(F.col("nlo").isNull(), F.col("lam") - 4).when(F.col("nhi").isNull(), F.col("lam") + 4).otherwise((F.col("nlo") + F.col("nhi")) / 2)
    still = F.col("done") | F.col("f").isNull() | (F.abs(miss) <= s.tolerance * F.greatest(F.col("target"), F.lit(1.0)))
    # a bracket as narrow as a double allows is as near as a target can be met
    narrow = F.coalesce(F.abs(F.col("nhi") - F.col("nlo")) <= 1e-14 * F.greatest(F.abs("nhi"), F.lit(1e-3)), F.lit(False))
    return moved.select(
        "sid",
        "target",
        "mean",
        F.when(still, F.col("lam")).when(inside, step).otherwise(middle).alias("lam"),
        F.when(F.col("done"), F.col("lo")).otherwise(F.col("nlo")).alias("lo"),
        F.when(F.col("done"), F.col("hi")).otherwise(F.col("nhi")).alias("hi"),
        (still | narrow).alias("done"),
    )


def newton(histogram: DataFrame, targets: DataFrame, s: Settings) -> DataFrame:
    """(sid, lam) solving every source's dual; lam is null where the target is all that may be taken.

    A few steps make one job over the histogram, whose result (a row per
    source) is written; a source that has converged stays as it is.
    """
    most = s.cap * F.col("source_size")
    state = targets.select(
        "sid",
        "target",
        (F.col("source_size") / F.col("n")).alias("mean"),
        F.lit(0.0).alias("lam"),
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
        (F.col("target") >= most).alias("done"),
    )
    for _ in range(s.rounds):
        for _ in range(s.steps):
            state = _step(histogram, state, s)
        left = Observation()
        state = written(state.coalesce(8).observe(left, F.count_if(~F.col("done")).alias("n")), "balance")
        if not left.get["n"]:
            break
    return state.join(targets.select("sid", "source_size"), "sid").select(
        "sid", F.when(F.col("target") >= most, None).otherwise(F.col("lam")).alias("lam"), "mean"
    )


def _walk(cap: int):
    """Copies of each (size, n, rate) cell of one source, from the largest size down."""

    def fold(cells: pa.Table) -> pa.Table:
        cells = cells.sort_by([("size", "descending")])
        due = taken = 0.0
        copies = []
        for size, n, rate in zip(*(cells.column(c).to_pylist() for c in ("size", "n", "rate")), strict=True):
            due += size * n * rate
            take = n if size == 0 else min(cap * n, max(0, round((due - taken) / size)))
            taken += size * take
            copies.append(take)
        return cells.select(["sid", "size", "n"]).append_column("copies", pa.array(copies, pa.int64()))

    return fold


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", settings: Settings | None = None) -> DataFrame:
    """(key, source, size, source_size, target, copies, m, extra): one row per distinct (key, source, size).

    ``m`` is the number of input rows it stands for; each of them is taken
    ``copies`` times, and ``extra`` of them, fewer than ``m``, once more.  A null text has size 0, a null source is a source of
    its own, a null key is a key like any other.  Documents of size 0 are
    taken once and count nothing.  An empty table gives no rows; a mix whose
    words are all zero has targets 0.
    """
    s = settings or Settings()
    units = written(
        docs.select(F.col(key).alias("k"), F.col(source).alias("source"), word_count(text).alias("size"))
        .groupBy("k", "source", "size")
        .agg(F.count(F.lit(1)).alias("m")),
        "mix-sizes",
    )
    cells = units.groupBy("source", "size").agg(F.sum("m").alias("n"))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    targets = written(source_targets(sources, s).coalesce(8), "mix-targets")
    t = targets.select("sid", F.col("source").alias("s"))
    histogram = written(cells.join(t, F.col("source").eqNullSafe(F.col("s"))).select("sid", "size", "n"), "mix-histogram")
    solved = newton(histogram, targets, s)
    rates = histogram.join(solved, "sid").withColumn(
        "rate", F.when(F.col("lam").isNull(), F.lit(float(s.cap))).otherwise(_rate(F.col("lam"), F.col("size") / F.col("mean"), s.cap))
    )
    # a group holds the distinct sizes of a source: bounded by its longest text, not by its documents
    copies = rates.select("sid", "size", "n", "rate").groupBy("sid").applyInArrow(_walk(s.cap), "sid int, size bigint, n bigint, copies bigint")
    copies = written(copies, "mix-copies")

    placed = (
        units.join(targets.select("sid", F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .join(copies, ["sid", "size"])
        .withColumn("h", F.xxhash64(F.coalesce(F.col("k").cast("string"), F.lit(""))))
        .withColumn("part", F.pmod(F.col("h"), F.ceil(F.col("n") / s.part)))
        .repartition("sid", "size", "part")  # so that the join on a common size may be split
    )
    parts = placed.groupBy("sid", "size", "part").agg(F.sum("m").alias("pn"), F.max("n").alias("n"), F.max("copies").alias("copies"))
    within = Window.partitionBy("sid", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    upto = lambda c: F.floor(F.col("copies").cast("decimal(19,0)") * c.cast("decimal(19,0)") / F.col("n").cast("decimal(19,0)")).cast("bigint")
    parts = parts.withColumn("cum", F.sum("pn").over(within)).select(
        "sid", "size", "part", "pn", (upto(F.col("cum")) - upto(F.col("cum") - F.col("pn"))).alias("pc")
    )
    order = Window.partitionBy("sid", "size", "part").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    dealt = placed.join(parts, ["sid", "size", "part"]).withColumn("ahead", F.coalesce(F.sum("m").over(order), F.lit(0)))
    base = F.floor(F.col("pc") / F.col("pn")).cast("bigint")
    # the part's copies beyond those that all its rows get go to its first rows, also within equal ones
    extra = F.greatest(F.lit(0), F.least(F.col("m"), F.col("pc") % F.col("pn") - F.col("ahead"))).cast("bigint")
    all_ = extra == F.col("m")
    return dealt.select(F.col("k").alias(key), F.col("source").alias(source), "size", "source_size", "target", (base + all_.cast("bigint")).alias("copies"), "m", F.when(all_, 0).otherwise(extra).alias("extra"))


def _numbered(rows: DataFrame, unit: list[str]) -> DataFrame:
    """``rows`` with ``__row``, from 1 within each unit; equal rows of any number are dealt over the tasks that hold them.

    Rows are written with their task, numbered within it, and moved on by
    the rows that their unit has in the tasks before.
    """
    held = written(rows.withColumn("__task", F.spark_partition_id()), "mix-repeated")
    sizes = held.groupBy(*unit, "__task").agg(F.count(F.lit(1)).alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy(*unit).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*(F.col(c).alias(f"{c}_") for c in [*unit, "__task"]), F.coalesce(ahead, F.lit(0)).alias("__ahead"))
    same = F.lit(True)
    for c in [*unit, "__task"]:
        same = same & held[c].eqNullSafe(sizes[f"{c}_"])
    within = F.row_number().over(Window.partitionBy(*unit, "__task").orderBy("__order"))
    joined = held.join(sizes, same).withColumn("__row", F.col("__ahead") + within)
    return joined.drop("__task", "__ahead", "__order", *(f"{c}_" for c in [*unit, "__task"]))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", settings: Settings | None = None) -> DataFrame:
    """The mix itself: each input row repeated as often as it is taken, numbered by ``copy`` from 1.

    Cases as for ``mix``: null keys, sources and texts are values like any
    other, an empty text is taken once, repeated rows are taken as often as
    their number asks, and very long texts count whole.  All columns pass
    through, and one called ``copy`` is replaced.
    """
    names = ["__k", "__s", "__size"]
    plan = mix(docs, key, text, source, settings).select(
        F.col(key).alias("__k"), F.col(source).alias("__s"), F.col("size").alias("__size"), F.col("copies").alias("__c"), F.col("extra").alias("__e")
    )
    plan = written(plan, "mix-plan")
    split = F.col("__e") > 0
    sized = docs.select("*", F.col(key).alias("__k"), F.col(source).alias("__s"), word_count(text).alias("__size"))

    def planned(plan: DataFrame) -> DataFrame:
        told = plan.withColumnsRenamed({c: f"{c}_" for c in names})
        same = sized["__k"].eqNullSafe(told["__k_"]) & sized["__s"].eqNullSafe(told["__s_"]) & (sized["__size"] == told["__size_"])
        return sized.join(told, same).drop("__k_", "__s_", "__size_")

    taken = planned(plan.where(~split))
    if plan.where(split).limit(1).count():  # rows that share key, source and size, of which some are taken once more
        repeated = planned(plan.where(split)).withColumn("__order", F.xxhash64(text))
        repeated = _numbered(repeated, names).withColumn("__c", F.col("__c") + (F.col("__row") <= F.col("__e")).cast("bigint")).drop("__row")
        taken = taken.unionByName(repeated)
    taken = taken.where("__c > 0").drop(*names, "__e")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__c")))).drop("__c")
