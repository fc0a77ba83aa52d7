"""Token counts by a map-side two-tier lookup of pre-token lengths.

Tier 1 is a bounded table of frequent pre-tokens with their token counts,
broadcast once.  Tier 2 is a bounded cache in each Python worker that
encodes what tier 1 misses.  A document is counted where it is read: no
pre-token ever crosses a shuffle.

The two tiers only decide how fast a length is found.  Every length comes
from the tokenizer library itself, so counts are exact whatever the table
holds.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The public byte-level pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Code points whose letter or number class differs between Unicode versions, so that
#: ``regex`` and the library may cut them differently (tests compare all others). A text with one of
#: them is encoded whole by the library.
UNSURE = regex.compile(
    "[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7ff\uab6c\uab6d"
    "\U00010000-\U0001efff\U00020000-\U0010ffff]"
)

#: Characters of a text that are cut into pre-tokens at once.
PIECE = 1 << 20


def _alphabet() -> dict[int, str]:
    """The public byte-to-character alphabet of byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        shown[b] = chr(256 + i)
    return shown


class Lengths:
    """Counts tokens in one worker: tier 1, then tier 2, then the library.

    ``cache`` bounds tier 2: two generations of at most that many entries;
    when the young one is full it becomes the old one.
    """

    def __init__(self, path: str, frequent: dict[str, int], cache: int = 100_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.fast = (
            spec["model"]["type"] == "BPE"
            and spec["normalizer"] is None
            and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel"
            and not spec["pre_tokenizer"]["add_prefix_space"]
            and spec["pre_tokenizer"]["use_regex"]
        )
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.pattern = regex.compile(PATTERN)
        self.model, self.shown = self.whole.model, _alphabet()
        self.frequent, self.young, self.old, self.cache = frequent, {}, {}, cache

    def library(self, text: str) -> int:
        return len(self.whole.encode(text, add_special_tokens=False))

    def miss(self, pretoken: str) -> int:
        n = self.young.get(pretoken)
        if n is None:
            n = self.old.get(pretoken)
            if n is None:
                n = len(self.model.tokenize(pretoken.encode().decode("latin-1").translate(self.shown)))
            if len(pretoken) <= 64:  # long ones hardly come again
                if len(self.young) >= self.cache:
                    self.old, self.young = self.young, {}
                self.young[pretoken] = n
        return n

    def pretokens(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text, piece by piece.

        A pre-token takes at most the one space before it, so a cut between
        a non-space and a space never parts one.
        """
        at, n = 0, len(text)
        while at < n:
            cut = min(n, at + PIECE)
            while cut < n and not (text[cut] == " " and not text[cut - 1].isspace()):
                cut += 1
            yield self.pattern.findall(text, at, cut) if at or cut < n else self.pattern.findall(text)
            at = cut

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.fast or UNSURE.search(text) or any(t in text for t in self.added):
            return self.library(text)
        total, known, miss = 0, self.frequent.get, self.miss
        for found in self.pretokens(text):
            for pretoken in found:
                total += known(pretoken) or miss(pretoken)
        return total


_WORKER: dict[tuple, Lengths] = {}


def _lengths(path: str, packed: bytes, cache: int) -> Lengths:
    """The worker's counter for this table (kept while the worker lives; one at a time)."""
    key = (path, zlib.crc32(packed), len(packed), cache)
    if key not in _WORKER:
        _WORKER.clear()
        pairs = json.loads(zlib.decompress(packed)) if packed else []
        _WORKER[key] = Lengths(path, dict(pairs), cache)
    return _WORKER[key]


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text", size: int = 32_768, sample_docs: int = 4_096) -> bytes:
    """The packed tier-1 table: the ``size`` commonest pre-tokens of a bounded sample, with lengths.

    The sample is ``sample_docs`` documents drawn by a hash of the text over
    the whole table.  Each task sums its own documents and hands over at most
    ``size`` pre-tokens of up to 64 characters, and there are at most 8 tasks.
    """
    n = docs.count()
    if not n:
        return b""
    share = min(1.0, sample_docs / n)
    drawn = docs.select(F.col(text).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def top(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, lengths = Counter(), Lengths(tokenizer, {})
        for frame in frames:
            for value in frame.column(0).to_pylist():
                if value and lengths.fast:
                    for found in lengths.pretokens(value):
                        counter.update(x for x in found if len(x) <= 64)
            if len(counter) > 8 * size:
                counter = Counter(dict(counter.most_common(4 * size)))
        best = [x for x, _ in counter.most_common(size)]
        yield pa.RecordBatch.from_pydict(
            {
                "p": pa.array(best, pa.string()),
                "c": pa.array([counter[x] for x in best], pa.int64()),
                "n": pa.array([lengths.miss(x) for x in best], pa.int64()),
            }
        )

    rows = drawn.repartition(8).mapInArrow(top, "p string, c bigint, n bigint")
    counts: Counter = Counter()
    length: dict[str, int] = {}
    for row in rows.toLocalIterator():
        counts[row.p] += row.c
        length[row.p] = row.n
    best = sorted(counts, key=lambda x: (-counts[x], x))[:size]
    return zlib.compress(json.dumps([(x, length[x]) for x in best]).encode(), 6)


def token_counter(spark, tokenizer: str, packed: bytes, cache: int = 100_000):
    """An Arrow UDF text -> number of tokens (null and empty: 0)."""
    shared = spark.sparkContext.broadcast(packed)

    @F.arrow_udf("bigint")
    def n_tokens(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths = _lengths(tokenizer, shared.value, cache)
        for values in frames:
            yield pa.array([lengths.count(x.as_py()) for x in values], pa.int64())

    return n_tokens


def with_token_counts(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    column: str = "n_tokens",
    frequent: int = 32_768,
    sample_docs: int = 4_096,
    cache: int = 100_000,
) -> DataFrame:
    """Add the number of tokens of each whole text, as the library counts them.

    No begin, end or other added tokens; special strings inside a text count
    as the library's default does; nothing is cut or padded.  A null or empty
    text has 0 tokens; repeated rows stay repeated; an empty table gives an
    empty result; other columns pass through (a column called ``column`` is
    replaced).
    """
    packed = frequent_lengths(docs, tokenizer, text, frequent, sample_docs)
    return docs.withColumn(column, token_counter(docs.sparkSession, tokenizer, packed, cache)(F.col(text)))


def utf8_bytes(text: str | Column) -> Column:
    """UTF-8 length; a null text has 0 bytes."""
    return F.coalesce(F.octet_length(F.col(text) if isinstance(text, str) else text).cast("bigint"), F.lit(0).cast("bigint"))
