import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.operators import packing
from kiln.sources import packed

SIZE = 8
KIND = "split string, block bigint, n_real int, input_ids array<int>, labels array<int>, loss_mask array<int>"


def blocks(spark, counts):
    rng = np.random.default_rng(2)
    rows = []
    for split, n in counts.items():
        for b in range(n):
            ids = [int(x) for x in rng.integers(0, 2**31 - 1, SIZE)]
            rows.append((split, b, int(rng.integers(1, SIZE + 1)), ids, ids[1:] + [0], [int(x) for x in rng.integers(0, 2, SIZE)]))
    return rows, spark.createDataFrame(rows, KIND)


@pytest.mark.parametrize("files,per_partition", [(1, 3), (4, 1000), (7, 1)])
def test_round_trip(spark, tmpdir_fresh, files, per_partition):
    rows, frame = blocks(spark, {"train": 53, "val": 5})
    path = os.path.join(tmpdir_fresh, "packed")
    packed.write_blocks(frame.repartition(5), path, SIZE, files=files)
    back = packed.read_blocks(spark, path, per_partition=per_partition)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sorted(map(tuple, packed.read_blocks(spark, path, "val").collect())) == sorted(r for r in rows if r[0] == "val")
    assert packed.block_count(path, "train") == 53 and packed.block_count(path, "none") == 0
    if per_partition == 1:
        assert back.rdd.getNumPartitions() == 58  # planned by block range


def test_overwriting_leaves_one_set_of_files(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "packed")
    packed.write_blocks(blocks(spark, {"train": 9})[1], path, SIZE)
    rows, frame = blocks(spark, {"train": 4})
    packed.write_blocks(frame, path, SIZE)
    assert sorted(map(tuple, packed.read_blocks(spark, path).collect())) == sorted(rows)
    assert len([f for f in os.listdir(path) if f.endswith(".kpb")]) == len({r["file"] for r in packed._manifest(path)["runs"]})
    packed.write_blocks(frame.limit(0), path, SIZE)
    assert packed.read_blocks(spark, path).count() == 0


def test_an_aborted_write_leaves_nothing(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "packed")
    rows, frame = blocks(spark, {"train": 20})
    bad = frame.withColumn("labels", F.when(F.col("block") == 17, F.array(F.lit(1))).otherwise(F.col("labels")))
    with pytest.raises(Exception):
        packed.write_blocks(bad, path, SIZE, files=3)
    assert [f for f in os.listdir(path)] == []


def test_draws_read_only_their_blocks(spark, tmpdir_fresh, monkeypatch):
    rows, frame = blocks(spark, {"train": 300, "val": 3})
    path = os.path.join(tmpdir_fresh, "packed")
    packed.write_blocks(frame, path, SIZE, files=5)
    plan = packing.batch_draws(spark, 6, 4, packed.block_count(path, "train"), seed=9)
    by = {r[1]: r for r in rows if r[0] == "train"}
    got = packed.lookup(plan, path).collect()
    assert len(got) == 24 and {(r.step, r.slot) for r in got} == {(i, j) for i in range(6) for j in range(4)}
    assert all((r.n_real, r.input_ids, r.labels, r.loss_mask) == by[r.block][2:] for r in got)
    joined = packing.batch_plan(frame, 6, 4, seed=9)
    assert sorted((r.step, r.slot, r.block, r.n_real) for r in got) == sorted((r.step, r.slot, r.block, r.n_real) for r in joined.collect())
    with pytest.raises(Exception):
        packed.lookup(plan.withColumn("block", F.col("block") + 300), path).collect()
    # damage all blocks but one: only it can still be read
    keep = packed._manifest(path)["runs"][0]
    for f in os.listdir(path):
        if f.endswith(".kpb"):
            full = os.path.join(path, f)
            with open(full, "r+b") as out:
                out.truncate(packed.width(SIZE) if f == keep["file"] else 0)
    one = spark.createDataFrame([(0, keep["first"])], "step bigint, block bigint")
    assert packed.lookup(one, path, keep["split"]).first().input_ids == by[keep["first"]][3]


def test_runs_follow_the_order_written():
    runs = packed.runs_of(["a", "a", "a", "b", "b"], np.array([3, 4, 7, 0, 1]), "f")
    assert [(r["split"], r["first"], r["n"], r["at"]) for r in runs] == [("a", 3, 2, 0), ("a", 7, 1, 2), ("b", 0, 2, 3)]


def test_a_task_encodes_some_blocks_at_a_time(tmp_path, monkeypatch):
    most, real = [], packed.encode
    monkeypatch.setattr(packed, "encode", lambda ids, *rest: most.append(len(ids)) or real(ids, *rest))
    n, size = 1000, 4
    ids = np.arange(n * size, dtype=np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(x)) for x in (ids, ids + 1, ids % 2)]
    frame = pa.RecordBatch.from_arrays([pa.array(["train"] * n), pa.array(np.arange(n)), pa.array(np.full(n, 3, np.int32)), *lists], [c.split()[0] for c in packed.COLUMNS.split(", ")])
    writer = packed.PackedWriter(str(tmp_path), size, True)
    told = writer.write(iter([frame, frame.slice(0, 0)]))
    writer.commit([told])
    assert sum(most) == n and max(most) < n and [(r["first"], r["n"]) for r in told.runs] == [(0, n)]
    reader = packed.PackedReader(str(tmp_path), 4096, None)
    back = pa.Table.from_batches([b for part in reader.partitions() for b in reader.read(part)])
    assert back["input_ids"].combine_chunks().flatten().to_pylist() == ids.tolist()
    assert back["labels"].combine_chunks().flatten().to_pylist() == (ids + 1).tolist()


def test_blocks_that_ids_tell_are_short(spark, tmpdir_fresh):
    rows, _ = blocks(spark, {"train": 600, "val": 3})
    short = lambda r: (*r[:4], [*r[3][1:], 7], [1] * r[2] + [0] * (SIZE - r[2]))
    rows = [r if r[0] == "val" or r[1] >= 550 else short(r) for r in rows]
    path = os.path.join(tmpdir_fresh, "packed")
    packed.write_blocks(spark.createDataFrame(rows, KIND), path, SIZE, files=1)
    assert sorted(map(tuple, packed.read_blocks(spark, path).collect())) == sorted(rows)
    runs = packed._manifest(path)["runs"]
    assert [(r["split"], r["first"], r["n"], r["at"], r["pad"]) for r in runs] == [("train", 0, 512, 0, 7), ("train", 512, 88, 0, None), ("val", 0, 3, 88, None)]
    size = {f: os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".kpb")}
    assert size[runs[0]["file"]] < 512 * packed.width(SIZE, short=True) + 400 < 512 * packed.width(SIZE)
    by = {r[1]: r for r in rows if r[0] == "train"}
    plan = spark.createDataFrame([(i, b) for i, b in enumerate([3, 511, 512, 3, 599, 0])], "slot int, block bigint")
    got = packed.lookup(plan.coalesce(1), path).collect()
    assert sorted((r.slot, r.n_real, r.input_ids, r.labels, r.loss_mask) for r in got) == sorted((i, *by[b][2:]) for i, b in enumerate([3, 511, 512, 3, 599, 0]))


def test_many_ranges_share_partitions(spark, tmpdir_fresh, monkeypatch):
    rows, frame = blocks(spark, {"train": 53, "val": 5})
    path = os.path.join(tmpdir_fresh, "packed")
    packed.write_blocks(frame, path, SIZE, files=3)
    monkeypatch.setattr(packed, "PARTITIONS", 6)
    reader = packed.PackedReader(path, 2, None)
    parts = reader.partitions()
    assert len(parts) <= 6 and all(r.n <= 2 for p in parts for r in p.ranges)
    back = pa.Table.from_batches([b for p in parts for b in reader.read(p)])
    assert sorted(zip(*(back[c].to_pylist() for c in back.column_names))) == sorted(rows)
