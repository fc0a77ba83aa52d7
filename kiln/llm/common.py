"""Small helpers shared by the operators: folds, UTF-8 buffers, written stage tables."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import stage_table

#: Byte classes of the word definition ``[^\x20\x09-\x0D]+`` on UTF-8 bytes.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: The same definition for JVM regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one vectorised step handles; bounds the temporaries of a task.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null for a null key."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % modulus


def held_out(key: str | Column, modulus: int, rest: int) -> Column:
    """True where the remainder is ``rest``; a null key is not held out."""
    return F.coalesce(remainder(key, modulus) == rest, F.lit(False))


def learnable(key: str | Column, modulus: int, rest: int) -> Column:
    """True where learning may use the row; a null key has no remainder and is never learned from."""
    return F.coalesce(remainder(key, modulus) != rest, F.lit(False))


def drawn(keys: DataFrame, group: str, most: Column) -> DataFrame:
    """About ``most`` rows of each ``group``, by a hash of the column ``k``; groups that have fewer keep all.

    A share per group follows from its size, so no group is ordered or gathered;
    ``most`` may depend on the group.
    """
    sizes = keys.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    draw = F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return keys.join(sizes, group).where(draw < most / F.col("__n")).drop("__n")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again (cuts the lineage)."""
    return stage_table(df, what)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of length n+1, bytes) of a string or binary column; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif not pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]) if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return off - off[0], raw


def pieces(offsets: np.ndarray, data: np.ndarray, step: int = STEP_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """Cut rows into runs (first row, last row + 1, first byte, last byte + 1) of about ``step`` bytes.

    Short rows are taken together; a row above ``step`` is cut after a word
    separator, at places that depend on that row alone, so nothing that is
    computed per word or within words changes with the batch it came in.
    """
    n, i = len(offsets) - 1, 0
    while i < n:
        if offsets[i + 1] - offsets[i] > step:
            at, end = int(offsets[i]), int(offsets[i + 1])
            while end - at > step:
                back = np.flatnonzero(IS_SPACE[data[at : at + step]])
                if len(back):
                    cut = at + int(back[-1]) + 1
                else:
                    ahead = np.flatnonzero(IS_SPACE[data[at + step : end]])
                    cut = at + step + int(ahead[0]) + 1 if len(ahead) else end
                yield i, i + 1, at, cut
                at = cut
            if at < end:
                yield i, i + 1, at, end
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
        yield i, j, int(offsets[i]), int(offsets[j])
        i = j


def batches(frames: Iterator[pa.RecordBatch], text: int, step: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice record batches so that one slice holds about ``step`` bytes of text (one row at least)."""
    for frame in frames:
        offsets, _ = utf8(frame.column(text))
        i, n = 0, frame.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
            yield frame.slice(i, j - i)
            i = j


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte buffer."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(IS_SPACE[data], out=inside[1:-1].view(bool))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn[0::2], turn[1::2]


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and xor-shift."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(p: np.uint64, n: int, keep: bool = True) -> np.ndarray:
    """p**0 ... p**(n-1); those of one step are kept, 8 MB in every worker, for what asks for them at each step."""
    kept = _KEPT.get(int(p))
    if kept is not None and n <= len(kept):
        return kept[:n]
    out = np.full(max(n, STEP_BYTES + 2) if keep else n, p, np.uint64)
    out[:1] = 1
    np.multiply.accumulate(out, out=out)
    if keep and n <= STEP_BYTES + 2:
        _KEPT[int(p)] = out
    return out[:n]


_KEPT: dict[int, np.ndarray] = {}
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a prefix polynomial over the buffer, shifted back to position 0.

    sum(byte * p**i) over the word is a difference of prefix sums; multiplying
    by p**-start makes it independent of where the word stands.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_ODD, len(data)), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * powers(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def long_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes of a long buffer, a step at a time."""
    out, i = [np.zeros(0, np.uint64)], 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + STEP_BYTES, "right")))
        out.append(word_hashes(data[lo : int(ends[j - 1])], starts[i:j] - lo, ends[i:j] - lo))
        i = j
    return np.concatenate(out)


def row_words(offsets: np.ndarray, data: np.ndarray, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, row of every word) of a column of texts; ``fold`` maps bytes first."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j, lo, hi in pieces(offsets, data):
        raw = data[lo:hi] if fold is None else fold[data[lo:hi]]
        starts, ends = word_spans(raw)
        if j - i > 1 and len(starts):  # a row's end ends a word, too
            edge = offsets[i + 1 : j] - lo
            inner = np.searchsorted(starts, edge, "left")
            split = edge[(inner > 0) & (ends[np.maximum(inner - 1, 0)] > edge)]
            if len(split):
                split = np.unique(split)
                starts, ends = np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))
        hashes.append(word_hashes(raw, starts, ends))
        rows.append(i + np.searchsorted(offsets[i + 1 : j], starts + lo, "right"))
    return np.concatenate(hashes), np.concatenate(rows)


def trim() -> None:
    """Hand freed memory back at the end of a task: Python workers live on and would keep it."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def runs(frames: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple[int, list]]:
    """(value of the key column, rows as tuples) of each run of equal keys."""
    now, held = None, []
    for frame in frames:
        for row in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            if held and row[key] != now:
                yield now, held
                held = []
            now = row[key]
            held.append(row)
    if held:
        yield now, held
