"""A data source of packed blocks with random access.

A file holds blocks of fixed width, one after the other: ``block_size`` ids
and labels as 32-bit integers and as many mask bytes; or, in a short file,
the ids alone, where labels are the next ids and one pad, the mask is 1 on the
real tokens, and both are told again from these.  A footer says which
blocks a file holds, as runs of consecutive numbers of a split, and a
manifest in the folder lists the runs of all files.  So a block's place is
arithmetic on its number: a reader plans its partitions by block range, and
``lookup`` reads single blocks by offset.

A task writes one file, or two where short blocks come before others; the manifest is written on commit, so a folder
without one holds nothing, and an aborted write removes its files.
"""

from __future__ import annotations

import itertools
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from kiln.session import shuffles_removed

MAGIC, SHORT_MAGIC = b"KPB1", b"KPB2"
MANIFEST = "_manifest.json"
#: Blocks that a task holds in the format at once.
STEP = 256
#: Partitions of a read; beyond, a partition takes several ranges, as starting one costs more than reading some blocks.
PARTITIONS = 1000
COLUMNS = "split string, block bigint, n_real int, input_ids array<int>, labels array<int>, loss_mask array<int>"


def _open(path: str):
    """(file system, path in it) of a folder given as path or URI; not only of local ones."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def width(block_size: int, short: bool = False) -> int:
    """Bytes of one block: ids, labels, mask, and the number of real tokens; of a short one, ids and that number."""
    return (4 if short else 9) * block_size + 4


def pad_of(ids: np.ndarray, labels: np.ndarray, mask: np.ndarray, n_real: np.ndarray) -> int | None:
    """The pad, if the ids, it and ``n_real`` tell the labels and the mask of all these blocks."""
    if not len(ids) or not ids.shape[1]:
        return None
    pad = labels[0, -1]
    told = (labels[:, -1] == pad).all() and (labels[:, :-1] == ids[:, 1:]).all() and (mask == (np.arange(ids.shape[1]) < n_real[:, None])).all()
    return int(pad) if told else None


def encode(ids: np.ndarray, labels: np.ndarray, mask: np.ndarray, n_real: np.ndarray, short: bool = False) -> bytes:
    """Blocks one after the other."""
    n, size = ids.shape
    if short:
        return np.concatenate([ids.astype("<i4"), n_real.astype("<i4").reshape(n, 1)], axis=1).tobytes()
    out = np.empty((n, width(size)), np.uint8)
    out[:, : 4 * size] = ids.astype("<i4").view(np.uint8).reshape(n, -1)
    out[:, 4 * size : 8 * size] = labels.astype("<i4").view(np.uint8).reshape(n, -1)
    out[:, 8 * size : 9 * size] = mask.astype(np.uint8)
    out[:, 9 * size :] = n_real.astype("<i4").reshape(n, 1).view(np.uint8)
    return out.tobytes()


def decode(raw: bytes, size: int, pad: int | None = None) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(n_real, ids, labels, mask) columns of blocks; ``pad``: of short ones."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, width(size, pad is not None))
    n = len(rows)
    offsets = pa.array(np.arange(n + 1) * size, pa.int32())
    if pad is not None:
        both = rows.view("<i4")
        ids, n_real = both[:, :size], both[:, size]
        labels = np.concatenate([ids[:, 1:], np.full((n, 1), pad, np.int32)], axis=1)
        lists = (ids.ravel(), labels.ravel(), (np.arange(size) < n_real[:, None]).astype(np.int32).ravel())
        return pa.array(n_real, pa.int32()), *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in lists)
    part = lambda a, b: np.ascontiguousarray(rows[:, a:b]).view("<i4").ravel()
    lists = (part(0, 4 * size), part(4 * size, 8 * size), np.ascontiguousarray(rows[:, 8 * size : 9 * size]).astype(np.int32).ravel())
    return pa.array(part(9 * size, width(size)), pa.int32()), *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in lists)


def runs_of(splits: list[str], blocks: np.ndarray, file: str) -> list[dict]:
    """Runs of consecutive block numbers of one split, with the place of their first in the file."""
    out: list[dict] = []
    for i, (split, block) in enumerate(zip(splits, blocks.tolist(), strict=True)):
        last = out[-1] if out else None
        if last and last["split"] == split and last["first"] + last["n"] == block:
            last["n"] += 1
        else:
            out.append({"file": file, "split": split, "first": block, "n": 1, "at": i})
    return out


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    runs: list[dict]


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, block_size: int, overwrite: bool):
        self.path, self.size, self.overwrite = path.rstrip("/"), block_size, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        out, files, runs, splits, blocks, pad, done = None, [], [], [], [], None, False

        def ended() -> None:
            told = [r | {"pad": pad} for r in runs_of(splits, np.concatenate([np.zeros(0, np.int64), *blocks]), files[-1])]
            footer = json.dumps({"block_size": self.size, "pad": pad, "runs": told}).encode()
            out.write(footer + struct.pack("<q", len(footer)) + (MAGIC if pad is None else SHORT_MAGIC))
            out.close()
            runs.extend(told)

        try:
            for frame in (f.slice(i, STEP) for f in iterator for i in range(0, f.num_rows, STEP)):
                arrays = [frame.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("input_ids", "labels", "loss_mask")]
                if any(len(a) != frame.num_rows * self.size for a in arrays) or any(frame.column(c).null_count for c in ("split", "block")):
                    raise ValueError(f"a block needs a split, a number, and three arrays of {self.size}")
                parts = (*(a.reshape(-1, self.size) for a in arrays), frame.column("n_real").to_numpy(zero_copy_only=False))
                own = pad_of(*parts) if out is None or pad is not None else None
                if out is None or own != pad:  # the second file takes any block
                    if out is not None:
                        ended()
                        own = None
                    files.append(f"blocks-{uuid.uuid4().hex}.kpb")
                    out, splits, blocks, pad = system.open_output_stream(f"{root}/{files[-1]}"), [], [], own
                out.write(encode(*parts, pad is not None))
                splits += frame.column("split").to_pylist()
                blocks.append(frame.column("block").to_numpy(zero_copy_only=False))
            if out is not None:
                ended()
            done = True
        finally:
            if not done:
                if out is not None:
                    out.close()
                for name in files:
                    system.delete_file(f"{root}/{name}")
        return Written(files, runs)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        runs = [] if self.overwrite else _manifest(self.path)["runs"]
        old = {r["file"] for r in _manifest(self.path)["runs"]} if self.overwrite else set()
        runs += [r for m in messages if m for r in m.runs]
        with system.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps({"block_size": self.size, "runs": runs}).encode())
        for file in old:
            system.delete_file(f"{root}/{file}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        for m in messages:
            for name in m.files if m else ():
                system.delete_file(f"{root}/{name}")


def _manifest(path: str) -> dict:
    from pyarrow import fs

    system, root = _open(path)
    if system.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return {"block_size": 0, "runs": []}
    with system.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


@dataclass
class Range:
    file: str
    split: str
    first: int
    n: int
    at: int
    pad: int | None = None


@dataclass
class Ranges(InputPartition):
    ranges: list[Range]


class PackedReader(DataSourceReader):
    def __init__(self, path: str, per_partition: int, split: str | None):
        self.path, self.most, self.split = path.rstrip("/"), per_partition, split

    def partitions(self) -> list[Ranges]:
        runs = [r for r in _manifest(self.path)["runs"] if self.split in (None, r["split"])]
        ranges = [Range(r["file"], r["split"], r["first"] + i, min(self.most, r["n"] - i), r["at"] + i, r.get("pad")) for r in runs for i in range(0, r["n"], self.most)]
        together = max(1, -(-len(ranges) // PARTITIONS))
        return [Ranges(ranges[i : i + together]) for i in range(0, len(ranges), together)]

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing to read
            return
        system, root = _open(self.path)
        size = _manifest(self.path)["block_size"]
        for own in partition.ranges:
            wide = width(size, own.pad is not None)
            with system.open_input_file(f"{root}/{own.file}") as f:
                for i in range(0, own.n, STEP):
                    n = min(STEP, own.n - i)
                    raw = f.read_at(n * wide, (own.at + i) * wide)
                    n_real, *arrays = decode(raw, size, own.pad)
                    block = pa.array(np.arange(own.first + i, own.first + i + n))
                    yield pa.RecordBatch.from_arrays([pa.array([own.split] * n), block, n_real, *arrays], [c.split()[0] for c in COLUMNS.split(", ")])


class PackedBlocks(DataSource):
    """``spark.read.format("kiln_packed")``; options: path, block_size (to write), per_partition and split (to read)."""

    @classmethod
    def name(cls) -> str:
        return "kiln_packed"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> PackedReader:
        return PackedReader(self.options["path"], int(self.options.get("per_partition", 4096)), self.options.get("split"))

    def writer(self, schema: StructType, overwrite: bool) -> PackedWriter:
        return PackedWriter(self.options["path"], int(self.options["block_size"]), overwrite)


def write_blocks(blocks: DataFrame, path: str, block_size: int, files: int | None = None, ranged: bool = False) -> None:
    """Blocks in files by range of (split, block), so that a file's blocks are few runs.

    ``ranged``: each partition of ``blocks`` is such a range already (as
    ``pack_blocks`` leaves them); they are sorted one by one, and a task
    writes several one after the other, so that no block is moved.
    """
    blocks.sparkSession.dataSource.register(PackedBlocks)
    keys = ["split", "block"]
    if not ranged:
        blocks = blocks.repartitionByRange(files, *keys) if files else blocks.repartitionByRange(*keys)
    rows = blocks.sortWithinPartitions(*keys)
    rows = rows.coalesce(files) if ranged and files else rows
    rows = rows.selectExpr(*(f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in COLUMNS.split(", ")))
    with shuffles_removed(blocks.sparkSession):
        rows.write.format("kiln_packed").option("block_size", block_size).mode("overwrite").save(path)


def read_blocks(spark: SparkSession, path: str, split: str | None = None, per_partition: int = 4096) -> DataFrame:
    """All blocks, or those of one split, a partition per ``per_partition`` blocks of a run, or several such ranges where they are many."""
    spark.dataSource.register(PackedBlocks)
    reader = spark.read.format("kiln_packed").option("per_partition", per_partition)
    return (reader if split is None else reader.option("split", split)).load(path)


def block_count(path: str, split: str) -> int:
    """Blocks of a split, from the manifest."""
    return sum(r["n"] for r in _manifest(path)["runs"] if r["split"] == split)


def lookup(plan: DataFrame, path: str, split: str = "train") -> DataFrame:
    """``plan`` (with a ``block`` column) and the arrays of its blocks, read by offset.

    Draws are dealt by file and sorted by place; a task reads the blocks
    that it was dealt and no others, so n draws read n blocks.  A draw of a
    block that is not there is an error.
    """
    told = _manifest(path)
    size, root_path = told["block_size"], path.rstrip("/")
    runs = sorted((r["first"], r["n"], r["at"], r["file"]) for r in told["runs"] if r["split"] == split)  # as many as files, about
    first, n, at = (np.array([r[i] for r in runs], np.int64) for i in range(3))
    files = np.array([r[3] for r in runs], object)
    pads = {r["file"]: r.get("pad") for r in told["runs"]}

    def place(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            block = frame.column("block").to_numpy(zero_copy_only=False)
            run = np.searchsorted(first, block, "right") - 1
            if len(block) and (run.min() < 0 or (block >= first[run] + n[run]).any()):
                raise ValueError("a block of the plan is not in the folder")
            columns = [*frame.columns, pa.array(files[run], pa.string()), pa.array(at[run] + block - first[run])]
            yield pa.RecordBatch.from_arrays(columns, [*frame.schema.names, "file", "at"])

    names = plan.columns
    arrays = ["n_real", "input_ids", "labels", "loss_mask"]
    placed = plan.mapInArrow(place, StructType([*plan.schema.fields]).add("file", StringType()).add("at", LongType()))
    placed = placed.repartition("file", F.floor(F.col("at") / 4096)).sortWithinPartitions("file", "at")
    schema = StructType([*plan.schema.fields])
    for c in arrays:
        schema = schema.add(c, IntegerType() if c == "n_real" else ArrayType(IntegerType()))

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(root_path)
        now, f = None, None
        try:
            for frame in frames:
                for i in range(0, frame.num_rows, STEP):
                    part, raw = frame.slice(i, STEP), []
                    for file, at in zip(part.column("file").to_pylist(), part.column("at").to_pylist(), strict=True):
                        if file != now:
                            if f:
                                f.close()
                            now, f = file, system.open_input_file(f"{root}/{file}")
                        wide = width(size, pads[file] is not None)
                        raw.append((pads[file], f.read_at(wide, at * wide)))
                    found = [pa.RecordBatch.from_arrays([*decode(b"".join(b for _, b in own), size, pad)], arrays) for pad, own in itertools.groupby(raw, lambda x: x[0])]
                    columns = [pa.concat_arrays([x.column(c) for x in found]) for c in arrays]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *columns], [*names, *arrays])
        finally:
            if f:
                f.close()

    return placed.mapInArrow(read, schema)
