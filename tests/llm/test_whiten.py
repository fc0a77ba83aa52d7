import math

import numpy as np
import pytest
from llm_fixtures import SF001
from pyspark.sql import functions as F

from kiln.llm import catalog, whiten
from kiln.llm.common import table

KIND = "vec_id bigint, embedding array<float>, n string, whitened int"


def brute(rows, components=32):
    """Exact integers; covariance of the centred rows; eigenvectors; rows projected one by one."""
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], np.int64)
    n, sums = len(x), [int(c) for c in x.sum(axis=0)]
    deviation = [sum((n * int(a) - b) ** 2 for a, b in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * int(a) - b) / n for a, b in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value)[:components]
    return kept, deviation, centred @ vector[:, order] / np.sqrt(value[order]), value[order] / np.trace(cov)


def compare(rows, out, components=32):
    kept, deviation, whitened, explained = brute(rows, components)
    width = whitened.shape[1]
    assert len(out) == len(kept) * width and {r.n for r in out} == {len(kept)}
    got = {(r.vec_id, r.component): r for r in out}
    w = np.array([[got[k, c].whitened for c in range(1, width + 1)] for k, _ in kept])
    assert np.allclose(w * np.sign((w * whitened).sum(axis=0)), whitened, atol=1e-6)
    assert [got[k, 1].deviation for k, _ in kept] == deviation
    assert np.allclose([got[kept[0][0], c].explained for c in range(1, width + 1)], explained, rtol=1e-6)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error <= 1e-8
    assert np.abs(w.T @ w / len(w) - np.eye(width)).max() <= 1e-8


@pytest.mark.parametrize("block_bytes", [2 << 20, 8 * 6 * 7])
def test_equals_brute_force_in_one_block_and_in_many(spark, block_bytes):
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=6) @ mixing + 5)]) for i in range(300)]
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1002, [math.nan] * 6), (1003, [math.inf] * 6), (1004, []), (1005, [1.0, 2.0])]
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(5)
    compare(rows[:-2], whiten.whiten(given, settings=whiten.Settings(components=4, block_bytes=block_bytes)).collect(), 4)


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF001, "embeddings").collect()]
    compare(rows, catalog.op11_whitening(spark, SF001).collect())


def test_odd_tables(spark):
    empty = spark.createDataFrame([], KIND)
    assert whiten.whiten(empty).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, None, "", 0), (2, [math.nan], "", 0)], KIND)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", 0)] * 3, KIND)).count() == 0  # no variance
    line = spark.createDataFrame([(None, [0.0, 1.0], "", 0), (7, [1.0, 1.0], "", 0), (7, [1.0, 1.0], "", 0), (8, [-1.0, 1.0], "", 0)], KIND)
    out = whiten.whiten(line).collect()  # one direction; null and repeated keys are rows
    assert [r.component for r in out] == [1] * 4 and sorted(map(str, (r.vec_id for r in out))) == ["7", "7", "8", "None"]
    assert sum(r.whitened**2 for r in out) == pytest.approx(4) and out[0].explained == pytest.approx(1)


def test_deviation_is_exact_or_an_error():
    x = np.array([[3_000_000_000, 0]], np.int64)
    assert whiten._deviation(x, 1, np.zeros(2, np.int64)).tolist() == [9 * 10**18]
    with pytest.raises(OverflowError):
        whiten._deviation(x * 2, 1, np.zeros(2, np.int64))
    with pytest.raises(OverflowError):
        list(whiten._vectors(__import__("pyarrow").RecordBatch.from_pydict({"v": [[1e300]]}), whiten.Settings()))
