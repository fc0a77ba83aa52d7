import random

import numpy as np
import pytest
from llm_fixtures import WORDS, documents  # noqa: F401

from kiln.llm import dart
from kiln.llm.graph import components


def shingle_set(text, k=5):
    words = (text or "").split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_classes(rows, threshold=0.8):
    """Components over all pairs with Jaccard similarity of the shingle sets of at least the threshold."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def varied(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = rng.choice(WORDS) + str(rng.randrange(1000))
    return " ".join(out)


def test_classes_equal_brute_force(spark, documents):
    rng = random.Random(4)
    rows = []
    for g in range(25):
        base = [rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(rng.choice([3, 5, 40, 120]))]
        rows += [(len(rows) + i, varied(rng, base, rng.choice([0, 0, 1, 1, 2, 5]))) for i in range(rng.choice([1, 2, 6]))]
    found = {r.doc_id: r.class_id for r in dart.near_classes(documents(rows)).collect()}
    assert found == brute_classes(rows)


def test_a_large_group_around_a_center_hangs_together(spark, documents):
    """Copies that are near the center but not each other, in many small blocks."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))] + [(i, varied(rng, base, 3)) for i in range(1, 90)] + [(500, "quite another text of some words here")]
    settings = dart.Settings(block=16)
    found = {r.doc_id: (r.class_id, r.distinct_texts) for r in dart.near_classes(documents(rows), settings=settings).collect()}
    want = brute_classes(rows)
    assert {i: c for i, (c, _) in found.items()} == want
    assert found[500] == (500, 1)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "one"), (5, "one"), (6, "one two"), (None, "one"), (7, "x " * 30_000)]
    docs = documents(rows).withColumn("class_id", dart.F.lit("old")).withColumn("node", dart.F.lit(0))
    out = sorted(((r.doc_id, r.class_id, r.distinct_texts) for r in dart.near_classes(docs).collect()), key=str)
    assert out == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 4, 1), (5, 4, 1), (6, 6, 1), (None, 4, 1), (7, 7, 1)], key=str)
    assert dart.near_classes(documents([])).count() == 0
    left = sorted(((r.doc_id, r.text) for r in dart.kept(docs.where("doc_id < 7"), dart.near_classes(docs)).collect()), key=str)
    assert [i for i, _ in left] == [1, 2, 3, 4, 6]


def test_one_row_of_each_class_stays_where_keys_are_null_or_repeat(spark, documents):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "only null keys"), (None, "only null keys"), (None, near), (3, near), (5, "a clean text"), (5, near + " more"), (5, ""), (5, None), (None, ""), (None, "")]
    docs = documents(rows)
    left = sorted(((r.doc_id, r.text) for r in dart.kept(docs, dart.near_classes(docs)).collect()), key=str)
    assert left == sorted([(None, "only null keys"), (3, near), (5, "a clean text"), (5, ""), (5, None), (None, ""), (None, "")], key=str)


@pytest.mark.parametrize("counted", [False, True])
def test_signatures_agree_like_the_weighted_similarity(counted):
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 2**63, 600).astype(np.uint64)
    wa, wb = rng.integers(0, 6, 600).astype(float), rng.integers(0, 6, 600).astype(float)
    wb[:400] = wa[:400]
    if not counted:
        wa, wb = (wa > 1).astype(float), (wb > 1).astype(float)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    k = 4096
    sig = [dart.signatures(pool[w > 0], w[w > 0], np.zeros(int((w > 0).sum()), np.int64), 1, k, 3)[0] for w in (wa, wb)]
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k)


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    elements = rng.integers(1, 2**63, 500).astype(np.uint64)
    rows = np.sort(rng.integers(0, 7, 500))
    together = dart.signatures(elements, np.ones(500), rows, 7, 88, 1)
    for i in range(7):
        own = elements[rows == i]
        assert (dart.signatures(own, np.ones(len(own)), np.zeros(len(own), np.int64), 1, 88, 1)[0] == together[i]).all()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}


def test_classes_are_planned_once(spark, documents):
    """What reads the classes plans a join with a written table, not the way to it; the loop broadcasts nothing."""
    from kiln.llm import graph

    rows = [(i, " ".join(f"w{(i // 2) * 20 + j}" for j in range(20))) for i in range(6)]
    classes = dart.near_classes(documents(rows))
    plan = classes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate" not in plan and "Union" not in plan
    edges = spark.createDataFrame([(b"b", b"a"), (b"c", b"b")], "a binary, b binary")
    assert "Broadcast" not in graph._small(graph._large(edges))._jdf.queryExecution().executedPlan().toString()
    assert {bytes(r.component) for r in graph.components(edges).collect()} == {b"a"}
