import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(np.isin(ids, queries)):
        score = (x @ x[i]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def run(spark, rows, every=10, **kw):
    out = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % every == 0, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("spread", [0.1, 3.0])
def test_recall_and_exact_scores(spark, spread):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(20, 32))
    rows = [(i, [float(v) for v in centers[i % 20] + spread * rng.normal(size=32)]) for i in range(1500)]
    found, want = run(spark, rows), brute(rows, range(0, 1500, 10))
    assert found.keys() == want.keys() and all(len(v) == 5 for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {q: dict(brute(rows, [q], k=1500)[q]) for q in list(want)[:20]}
    assert all(abs(s - exact[q][i]) < 1e-9 for q in exact for i, s in found[q])


def test_equal_vectors_tie_by_id_however_many(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000, [3.0, 2.0, 1.0])]
    found = run(spark, rows, every=50, settings=ann.Settings(part=7))
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in found[50]] == [0, 1, 2, 3, 4] and [i for i, _ in found[1000]] == [0, 1, 2, 3, 4]


def test_unusable_vectors_take_no_part_and_few_candidates_are_all_returned(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [-1.0, 0.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.5]), (10, [1e-30, 1e-30])]
    vectors = frame(spark, rows).withColumn("score", F.lit("x")).withColumn("bucket", F.lit(1))
    out = ann.nearest(vectors, F.lit(True)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in out] == [(0, 10), (0, 7), (7, 10), (7, 0), (10, 0), (10, 7)]
    assert ann.nearest(frame(spark, []), F.lit(True)).count() == 0


def test_queries_that_find_too_little_see_every_row(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=16)]) for i in range(120)]
    found = run(spark, rows, settings=ann.Settings(tables=1, hashes=12, width=0.05, probes=1, part=13))
    assert found == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in brute(rows, range(0, 120, 10)).items()}


def test_perturbations_come_in_order_of_their_cost():
    inside = np.array([0.1, 0.45, 0.8])
    cost = lambda moves: sum((inside[j] if d < 0 else 1 - inside[j]) ** 2 for j, d in moves)
    sets = ann.perturbations(inside, 27)
    assert sets[0] == [] and len({tuple(sorted(s)) for s in sets}) == len(sets) == 27
    assert [cost(s) for s in sets] == sorted(cost(s) for s in sets)
