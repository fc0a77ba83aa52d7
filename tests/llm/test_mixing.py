import random

from llm_fixtures import documents  # noqa: F401

from kiln.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Share by weight; cap; hand the excess on; until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [n for n in names if n not in fixed]
        left = total - sum(fixed.values())
        give = {n: left * w[n] / sum(w[m] for m in open_) for n in open_}
        above = [n for n in open_ if give[n] > cap * sizes[n]]
        if not above:
            return fixed | give
        fixed |= {n: cap * sizes[n] for n in above}


def test_targets_and_taken_words(spark, documents):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 40, 300]), None, rng.choice(["a", "b", "b", "b", "é", "Z", None])) for i in range(900)]
    rows += [(10_000 + i, None, None, "b") for i in range(5)]
    plan = [r.asDict() for r in mixing.mix(documents(rows)).collect()]
    assert len(plan) == len(rows) and all(r["m"] == 1 for r in plan)
    sizes = {}
    for r in plan:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute_targets(sizes)
    for source, total in sizes.items():
        own = [r for r in plan if r["source"] == source]
        assert all(r["source_size"] == total and abs(r["target"] - want[source]) < 1e-6 for r in own)
        assert all(0 <= r["copies"] <= 2 for r in own)
        assert abs(sum(r["copies"] * r["size"] for r in own) - want[source]) <= 10
    assert sorted(map(str, plan)) == sorted(str(r.asDict()) for r in mixing.mix(documents(rows[::-1])).collect())


def test_rates_are_tilted_by_size(spark, documents):
    """Below the cap a source's larger documents are taken at least as often on average."""
    rows = [(i, "w " * (1 + i % 50), None, s) for i, s in enumerate(["a"] * 500 + ["b"] * 500 + ["c"] * 500)]
    plan = mixing.mix(documents(rows), settings=mixing.Settings(weights=(1, 1, 1), share=1.2)).where("source = 'a'").collect()
    small = [r.copies for r in plan if r["size"] <= 10]
    large = [r.copies for r in plan if r["size"] > 40]
    assert sum(small) / len(small) <= sum(large) / len(large)


def test_equal_documents_in_a_split_cell(spark, documents):
    rows = [(i, "one two three", None, "a" if i % 4 else "b") for i in range(400)]
    plan = mixing.mix(documents(rows), settings=mixing.Settings(part=17)).collect()
    want = brute_targets({"a": 900, "b": 300})
    for s in "ab":
        assert abs(sum(r.copies * r["size"] for r in plan if r.source == s) - want[s]) <= 3


def test_repeated_rows_meet_the_target(spark, documents):
    """1,000 equal rows and 500 with a null key are dealt their copies one by one."""
    rows = [(1, "one two three", None, "a")] * 1000 + [(None, "four five", None, "c")] * 500 + [(i, "w " * (1 + i % 9), None, "b") for i in range(600)]
    docs = documents(rows).repartition(7)
    sizes = {"a": 3000, "c": 1000, "b": sum(1 + i % 9 for i in range(600))}
    want = brute_targets(sizes)
    plan = mixing.mix(docs).collect()
    for s in sizes:
        taken = sum((r.copies * r.m + r.extra) * r["size"] for r in plan if r.source == s)
        assert abs(taken - want[s]) <= 9 and all(r.copies + (r.extra > 0) <= 2 and 0 <= r.extra < r.m for r in plan)
    out = mixing.mixed(docs.withColumn("node", mixing.F.monotonically_increasing_id())).collect()
    for s, n in (("a", 3), ("c", 2)):
        own = [r for r in out if r.source == s]
        assert abs(n * len(own) - want[s]) <= 9
        per_row = {}
        for r in own:
            per_row.setdefault(r.node, []).append(r.copy)
        assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2 for c in per_row.values())


def test_mixed_repeats_rows_and_odd_tables(spark, documents):
    docs = documents([(1, "a b c", "x", "s"), (1, "a b c", "x", "s"), (2, "d", "y", None), (None, "e f", None, "s")]).withColumn("copy", mixing.F.lit("old"))
    out = mixing.mixed(docs)
    assert set(out.columns) == set(docs.columns)
    assert all(r.copy >= 1 for r in out.collect())
    assert mixing.mix(documents([])).count() == 0 and mixing.mixed(documents([])).count() == 0
    blank = mixing.mix(documents([(1, None), (2, " ")])).collect()
    assert [(r["size"], r.target, r.copies) for r in blank] == [(0, 0.0, 1)] * 2
