import numpy as np
from pyspark.sql import functions as F

from kiln.operators.ordering import exact_quantiles, from_ordered_bits, ordered_bits, prefix_sums, prefix_totals


def test_prefix_sums_partition_independent(spark):
    rng = np.random.default_rng(3)
    keys = rng.choice(10**9, size=500, replace=False)
    vals = rng.integers(0, 1000, size=500)
    df = spark.createDataFrame([(int(k), int(v)) for k, v in zip(keys, vals)], "k long, v long")
    order = np.argsort(keys)
    expect = dict(zip(keys[order].tolist(), (np.cumsum(vals[order]) - vals[order]).tolist()))
    for parts in (1, 4, 17):
        sums, total = prefix_sums(df.repartition(parts), "k", "v", num_partitions=parts)
        got = {r.k: r.cum_before for r in sums.collect()}
        assert got == expect
        assert total == int(vals.sum())


def test_exact_quantiles_with_ties(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 1000)):
        vals = rng.integers(0, 7, size=n).astype(float) if g == "c" else rng.random(n)
        rows += [(g, float(x)) for x in vals]
    df = spark.createDataFrame(rows, "g string, x double")
    q = {r.g: r for r in exact_quantiles(df, "g", "x", [("median", 0.5), ("p95", 0.95)]).collect()}
    for g in ("a", "b", "c"):
        vals = np.array([x for gg, x in rows if gg == g])
        assert abs(q[g].median - np.median(vals)) < 1e-12
        assert abs(q[g].p95 - np.percentile(vals, 95)) < 1e-12
        assert q[g].n == len(vals)


def test_quantiles_over_many_values(spark):
    """More values than any sketch or bracket would hold, in few and in many range partitions."""
    df = spark.range(50_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 50_021).alias("x"))
    vals = np.array([(i * 7919) % 50_021 for i in range(50_000)], dtype=float)
    row = exact_quantiles(df, "g", "x", [("p01", 0.01), ("median", 0.5), ("p95", 0.95)]).first()
    assert (row.p01, row.median, row.p95) == tuple(np.percentile(vals, [1, 50, 95]))


def test_one_pass_carries_several_totals(spark):
    df = spark.createDataFrame([(3, 5), (1, 2), (2, 7)], "k long, v long")
    out, total = prefix_totals(df, ["k"], {"v0": F.col("v"), "n0": F.lit(1)})
    assert sorted(map(tuple, out.collect())) == [(1, 0, 0), (2, 2, 1), (3, 9, 2)] and total == {"v0": 14, "n0": 3}


def test_bits_keep_the_order_and_come_back():
    x = np.array([-np.inf, -1e300, -2.5, -1e-320, -0.0, 0.0, 5e-324, 0.1, 1.0, 1e300, np.inf, np.nan])
    bits = ordered_bits(x)
    assert (np.sort(bits) == bits).all() and bits[4] == bits[5] and len(set(bits.tolist())) == len(x) - 1
    back = [from_ordered_bits(int(b)) for b in bits]
    assert np.array_equal(back, x, equal_nan=True)


def test_quantiles_of_odd_values(spark):
    rows = [("a", -1.5), ("a", 3.0), ("a", None), ("a", -1.5), (None, 2.0), (None, 4.0), ("e", 1e-300), ("z", None)]
    q = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "g", "x", [("m", 0.5), ("top", 1.0)]).collect()}
    assert q.keys() == {"a", None, "e"}
    assert (q["a"].n, q["a"].m, q["a"].top, q[None].m, q["e"].m) == (3, -1.5, 3.0, 3.0, 1e-300)
    assert exact_quantiles(spark.createDataFrame([], "g string, x double"), "g", "x", [("m", 0.5)]).count() == 0


def test_histograms_bound_what_is_shuffled(spark):
    """50,000 distinct values: no pass hands over more than a histogram of one digit."""
    from kiln.operators.ordering import digit_counts

    vals = spark.range(50_000).select(F.lit("g").alias("g"), (F.col("id") * 0.37).alias("x"))
    first = digit_counts(vals, {"g": {0}}, 48)
    assert first.agg(F.sum("n")).first()[0] == 50_000 and first.count() < 2_000
