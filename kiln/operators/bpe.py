"""Byte-level BPE T1-T10 and the fertility reports A8, A9.

* Pretokens (T2) come from a JVM regex (GPT-2 pattern, space put in front).
* Training (T4) runs on the distinct-pretoken table, see ``bpe_train``.
* Encoding (T6) is one Arrow pass where the documents are: the merge ranks,
  bounded by the vocabulary, travel with it; nothing is exploded or shuffled.
  The distinct pretokens of some megabytes of text are merged together by
  array operations; very long ones by a heap over a linked list, n log n in
  their length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.config import TokenizerConfig
from kiln.functions.text import excerpt, py_split
from kiln.operators.ordering import exact_quantiles, with_prefix_sum
from kiln.operators.bpe_train import Learned, Phases, learn, word_symbols
from kiln.session import cut_lineage, stage_table

# Whitespace as the byte-level pretokenizer sees it (Unicode
# White_Space; unlike str.isspace() it excludes \x1C-\x1F).
BPE_WS = r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# The GPT-2 pretokenization pattern.
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + BPE_WS + r"\p{L}\p{N}]+"
    r"|[" + BPE_WS + r"]+(?![^" + BPE_WS + r"])|[" + BPE_WS + r"]+"
)


def byte_chars() -> list[str]:
    """GPT-2 byte-to-character rule: printable Latin-1 bytes map to themselves,
    the other 68 bytes to U+0100 upwards in byte order."""
    keep = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


BYTE_CHARS = byte_chars()


# ------------------------------------------------------------------ T2, T3
def with_prefix_space(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.when((F.length(t) == 0) | t.startswith(" "), t).otherwise(F.concat(F.lit(" "), t))


def pretokens(text: Column | str) -> Column:
    """Pretoken strings of a text (byte mapping happens on distinct pretokens)."""
    return F.regexp_extract_all(with_prefix_space(text), F.lit(PRETOKEN_PATTERN), 0)


def pretoken_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, cnt)`` corpus frequency of each pretoken (partial aggregation map-side)."""
    return docs.select(F.explode(pretokens(text_col)).alias("word")).groupBy("word").agg(F.count("*").alias("cnt"))


# ------------------------------------------------------------------ T4, T5
@dataclass
class BPEModel:
    tokens: list[bytes]  # id -> bytes (specials hold their own text)
    specials: tuple[str, ...]
    byte_ids: list[int]  # byte value -> id (-1 when the byte is unknown)
    merges: list[tuple[int, int, int]]  # rank order: (left, right, new id)
    rounds: int = 0  # phases the training took

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def token_string(self, i: int) -> str:
        if i < len(self.specials):
            return self.specials[i]
        return "".join(BYTE_CHARS[b] for b in self.tokens[i])

    def vocab_frame(self, spark) -> DataFrame:
        rows = [(i, self.token_string(i), self.tokens[i].hex().upper()) for i in range(len(self.tokens))]
        return spark.createDataFrame(rows, "id int, token string, hex string")

    def merges_frame(self, spark) -> DataFrame:
        rows = [(r, a, b, n) for r, (a, b, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int")


def train_bpe(docs: DataFrame, cfg: TokenizerConfig = TokenizerConfig(), text_col: str = "text", phases: Phases = Phases()) -> BPEModel:
    """T4/T5: greedy byte-level BPE (see ``bpe_train``); specials come first, then the bytes by their character.

    The loop runs in a session of its own without AQE: its shuffles are
    small pre-aggregated sums, which AQE would only plan again and again.
    """
    spark = docs.sparkSession
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    counts = stage_table(pretoken_counts(docs, text_col), "bpe-counts", quiet)
    present = list(range(256)) if cfg.seed_all_bytes else _present(counts)
    specials = tuple(cfg.special_tokens)
    order = sorted(present, key=lambda b: ord(BYTE_CHARS[b]))
    tokens: list[bytes] = [s.encode() for s in specials] + [bytes([b]) for b in order]
    byte_ids = [-1] * 256
    for i, b in enumerate(order):
        byte_ids[b] = len(specials) + i
    learned = Learned(tokens, {t: i for i, t in enumerate(tokens) if i >= len(specials)})
    words = stage_table(word_symbols(counts, byte_ids), "bpe-words")
    learn(words, learned, cfg.vocab_size, cfg.min_frequency, cfg.max_token_length, phases)
    return BPEModel(learned.tokens, specials, byte_ids, learned.merges, learned.phases)


def _present(counts: DataFrame) -> list[int]:
    """The byte values that occur in the words."""

    def seen(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set().union(*(w.encode() for f in frames for w in f.column("word").to_pylist()))
        yield pa.RecordBatch.from_pydict({"b": pa.array(sorted(found), pa.int32())})

    return sorted(r.b for r in counts.select("word").mapInArrow(seen, "b int").distinct().collect())


NEED = ("<pad>", "<bos>", "<eos>", "<unk>")


def contract(vocab: DataFrame, merges: DataFrame, encoded: DataFrame, cfg: TokenizerConfig) -> DataFrame:
    """T9 on the tables themselves: one row of facts about vocabulary, merges and encoded ids.

    ``encoded`` is ``(seq, ids)``; the specials are looked up by their text.
    """
    v = vocab.agg(
        F.count("*").alias("vocab_size"),
        F.countDistinct("id").alias("distinct_ids"),
        F.countDistinct("token").alias("distinct_tokens"),
        F.max("id").alias("max_id"),
        *[F.max(F.when(F.col("token") == s, F.col("id"))).alias(s.strip("<>")) for s in NEED],
    )
    m = merges.agg(F.count("*").alias("merges"), F.max(F.greatest("left_id", "right_id", "new_id")).alias("max_merge_id"))
    e = encoded.agg(F.max(F.array_max("ids")).alias("max_encoded_id"))
    rows = v.withColumn("one", F.lit(1)).join(m.withColumn("one", F.lit(1)), "one").join(e.withColumn("one", F.lit(1)), "one")
    size = F.col("vocab_size")
    specials = F.array(*[F.col(s.strip("<>")) for s in NEED])
    ok = (
        (F.col("distinct_ids") == size)
        & (F.col("distinct_tokens") == size)
        & (F.col("max_id") == size - 1)
        & (size <= cfg.vocab_size)
        & (F.size(F.array_distinct(F.filter(specials, lambda x: x.isNotNull()))) == len(NEED))
        & (F.coalesce("max_merge_id", F.lit(-1)) < size)
        & (F.coalesce("max_encoded_id", F.lit(-1)) < size)
    )
    return rows.drop("one").withColumn("contract_ok", ok)


# ------------------------------------------------------------------ T6, T7, T8
class Encoder:
    """Ids of one pretoken at a time."""

    def __init__(self, model: BPEModel):
        self.ranks = {(a, b): (r, n) for r, (a, b, n) in enumerate(model.merges)}
        self.unk = model.specials.index("<unk>") if "<unk>" in model.specials else 3

    def merge(self, ids: list[int]) -> list[int]:
        """Apply merges in rank order, leftmost first: a heap of pairs over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                found = self.ranks.get((ids[i], ids[j]))
                if found:
                    heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [x for x in ids if x >= 0]


#: Pretokens above this many bytes are merged by a heap, whose work does not grow with the number of rounds.
LONG = 256
#: Characters of texts whose pretokens are encoded at once.
PIECE = 4 << 20


class BatchEncoder:
    """Ids of all distinct pretokens of a batch by array operations.

    All words are one array of symbols.  A round finds each word's lowest
    rank, merges that pair wherever the word has it, from left to right, and
    sets aside the words without a pair that merges.
    """

    def __init__(self, model: BPEModel):
        self.single = Encoder(model)
        keys = np.array([a << 32 | b for a, b, _ in model.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.new = np.array([n for *_, n in model.merges], np.int64)
        self.bytes = np.array([self.single.unk if i < 0 else i for i in model.byte_ids], np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one word after the other, ids of each word)."""
        raw = words.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
        data = np.frombuffer(raw.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0]) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        word = np.repeat(np.arange(len(size)), size)
        short = size <= LONG
        inside = short[word]
        told, of = self.rounds(self.bytes[data[inside]], word[inside])
        for i in np.flatnonzero(~short).tolist():
            ids = self.single.merge(self.bytes[data[offsets[i] - offsets[0] : offsets[i + 1] - offsets[0]]].tolist())
            told.append(np.array(ids, np.int64))
            of.append(np.full(len(ids), i))
        flat, which = np.concatenate([np.zeros(0, np.int64), *told]), np.concatenate([np.zeros(0, np.int64), *of])
        return flat[np.argsort(which, kind="stable")], np.bincount(which, minlength=len(size))

    def rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, word of each id) in pieces; a word's ids stand together, in order."""
        told, of, none = [], [], np.int64(len(self.keys))
        while len(sym) and len(self.keys):
            key = sym[:-1] << np.int64(32) | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(sym), none)
            rank[:-1] = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], none)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            done = least == none
            told.append(sym[done])
            of.append(word[done])
            hit = (rank == least) & ~done
            # neighbouring hits overlap (a pair of equal symbols): every other one of a run is merged
            place = np.arange(len(hit))
            start = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), place, -1))
            hit &= (place - start) % 2 == 0
            sym = np.where(hit, self.new[np.minimum(rank, none - 1)], sym)
            keep = ~done
            keep[1:] &= ~hit[:-1]
            sym, word = sym[keep], word[keep]
        told.append(sym)
        of.append(word)
        return told, of


def _encoded(model: BPEModel, counts: bool):
    """Arrow UDF over arrays of pretokens: their ids, or the number of them."""

    @F.arrow_udf("bigint" if counts else "array<int>")
    def encode(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = BatchEncoder(model)
        for words in frames:
            for part in _pieces(words):  # a task holds the ids of one piece, not of its batch
                yield _ids(encoder, part, counts)

    return encode


def _pieces(words: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``PIECE`` characters (one row at least)."""
    strings = words.flatten()
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = length[np.cumsum(size)]
    i = 0
    while i < len(words):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PIECE, "right")))
        yield words.slice(i, j - i)
        i = j


def _ids(encoder: BatchEncoder, words: pa.Array, counts: bool) -> pa.Array:
    """The ids of each row's pretokens; equal pretokens are encoded once."""
    coded = words.flatten().dictionary_encode()
    flat, each = encoder(coded.dictionary)
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(each[which])])
    ends = upto[np.concatenate([[0], np.cumsum(rows)])]
    if counts:
        return pa.array(np.diff(ends))
    begin = (np.cumsum(each) - each)[which]
    n = each[which]
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[at], pa.int32()))


def encode_documents(docs: DataFrame, model: BPEModel, text_col: str = "text", order_col: str = "seq") -> DataFrame:
    """``(seq, ids)`` per document; a null or empty text has no id.

    Special tokens inside a text are ordinary text: their bytes are encoded.
    """
    return docs.select(order_col, _encoded(model, False)(pretokens(text_col)).alias("ids"))


def token_counts(docs: DataFrame, model: BPEModel, text_col: str = "text", order_col: str = "seq") -> DataFrame:
    """``(seq, n_tokens)`` without shipping the ids back."""
    return docs.select(order_col, _encoded(model, True)(pretokens(text_col)).alias("n_tokens"))


def token_strings(ids: Column | str, model: BPEModel) -> Column:
    """The token strings of an id array (the vocabulary travels as a broadcast in the UDF)."""
    spelled = [model.token_string(i) for i in range(model.vocab_size)]

    @F.arrow_udf("array<string>")
    def spell(arrays: pa.Array) -> pa.Array:
        return pa.array([None if x is None else [spelled[i] for i in x] for x in arrays.to_pylist()], pa.list_(pa.string()))

    return spell(F.col(ids) if isinstance(ids, str) else ids)


#: Ids whose text is spelled at once.
IDS = 1 << 20


def _stretches(arrays: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``IDS`` ids (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(arrays):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + IDS, "right")))
        yield arrays.slice(i, j - i)
        i = j


class Spelled:
    """The texts of id arrays: the bytes of all ids of a batch are gathered at once."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, arrays: pa.Array) -> pa.Array:
        ids = pc.fill_null(arrays.flatten(), 0).to_numpy(zero_copy_only=False)
        rows = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        n = self.size[ids]
        upto = np.concatenate([[0], np.cumsum(n)])
        data = self.data[np.repeat(self.first[ids] - upto[:-1], n) + np.arange(upto[-1])]
        offsets = upto[np.concatenate([[0], np.cumsum(rows)])]
        text = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        try:  # a row's bytes must be whole characters by themselves
            return text.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([r.decode("utf-8", errors="replace") for r in text.to_pylist()], pa.string())


def decode_documents(encoded: DataFrame, model: BPEModel, order_col: str = "seq") -> DataFrame:
    """``(seq, text)`` from ids: specials are skipped, and malformed bytes (of a cut block) become U+FFFD."""
    tokens = [b"" if i < len(model.specials) else t for i, t in enumerate(model.tokens)]

    @F.arrow_udf("string")
    def decode(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelled = Spelled(tokens)
        for arrays in frames:
            for part in _stretches(arrays):
                yield spelled(part)

    return encoded.select(order_col, decode(F.col("ids")).alias("text"))


def nfc(text: Column | str) -> Column:
    """Unicode NFC (pandas UDF; the JVM has no normaliser function)."""
    import unicodedata

    @F.pandas_udf(T.StringType())
    def _nfc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return _nfc(F.col(text) if isinstance(text, str) else text)


# ------------------------------------------------------------------ T1, A8, A9
def heldout_split(docs: DataFrame, shard_size: int, heldout: float = 0.1, order_col: str = "seq") -> DataFrame:
    """Shards in corpus order; the first ``int(n * (1 - heldout))`` train."""
    pos, n = with_prefix_sum(docs, order_col, None, "position")
    pos = pos.withColumn("shard", F.floor(F.col("position") / shard_size).cast("int"))
    n_train = int(-(-n // shard_size) * (1 - heldout))
    return pos.withColumn("heldout", F.col("shard") >= F.lit(n_train))


def fertility_rows(docs: DataFrame, n_tokens: DataFrame, text_col: str = "text", order_col: str = "seq") -> DataFrame:
    """Per document tokens, words, chars and both ratios; zero words/chars skipped."""
    d = docs.select(order_col, F.size(py_split(text_col)).alias("words"), F.length(text_col).alias("chars"))
    d = d.join(n_tokens, order_col).where((F.col("words") > 0) & (F.col("chars") > 0))
    return d.select(
        order_col,
        F.col("n_tokens").alias("tokens"),
        "words",
        "chars",
        (F.col("n_tokens") / F.col("words")).alias("tokens_per_word"),
        (F.col("n_tokens") / F.col("chars")).alias("tokens_per_char"),
    )


def fertility(rows: DataFrame) -> DataFrame:
    """Mean, median, p90 of both ratios, and the totals (one row per ratio).

    The per-document rows are read three times (quantile passes, totals), so
    they are materialised once; they are narrow (six numbers per document).
    """
    rows = cut_lineage(rows)
    long = rows.select(
        F.explode(
            F.array(
                F.struct(F.lit("tokens_per_word").alias("ratio"), F.col("tokens_per_word").alias("v")),
                F.struct(F.lit("tokens_per_char").alias("ratio"), F.col("tokens_per_char").alias("v")),
            )
        ).alias("x")
    ).select("x.ratio", "x.v")
    q = exact_quantiles(long, "ratio", "v", [("median", 0.5), ("p90", 0.9)])
    totals = rows.agg(
        F.count("*").alias("documents"),
        F.sum("tokens").cast("long").alias("total_tokens"),
        F.sum("words").cast("long").alias("total_words"),
        F.sum("chars").cast("long").alias("total_characters"),
    ).first()
    return q.select(
        "ratio",
        "mean",
        "median",
        "p90",
        F.lit(totals["documents"]).alias("documents"),
        F.lit(totals["total_tokens"]).cast("long").alias("total_tokens"),
        F.lit(totals["total_words"]).cast("long").alias("total_words"),
        F.lit(totals["total_characters"]).cast("long").alias("total_characters"),
    )


def worst_fertility(rows: DataFrame, docs: DataFrame, model: BPEModel, k: int = 20, order_col: str = "seq") -> DataFrame:
    """Top ``k`` by tokens per word, ties kept in corpus order, with their text
    (500 characters), decoded text, token strings and ids (k rows, so the join is bounded)."""
    worst = rows.orderBy(F.desc("tokens_per_word"), order_col).limit(k)
    texts = docs.join(F.broadcast(worst.select(order_col)), order_col, "left_semi").select(order_col, "text")
    ids = encode_documents(texts, model, "text", order_col)
    decoded = decode_documents(ids, model, order_col).withColumnRenamed("text", "decoded")
    told = ids.select(order_col, "ids", token_strings("ids", model).alias("token_strings"))
    return (
        worst.join(texts.select(order_col, excerpt("text", 500).alias("text")), order_col).join(decoded, order_col).join(told, order_col)
    )
