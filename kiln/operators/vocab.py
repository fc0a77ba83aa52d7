"""Word-level vocabulary: ``id = 4 + rank of the word`` (ids 0..3 are specials).

Used where an exactly checkable vocabulary is wanted (packing checked by
SQL); the byte-level BPE of ``kiln.operators.bpe`` is the production path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.ordering import prefix_sums
from kiln.session import drop_stage, stage_table

N_SPECIAL = 4


#: Bytes of texts that are split at once.
PIECE = 4 << 20
#: A block ends beyond so many bytes of texts or distinct words.
BLOCK, MOST = 32 << 20, 1 << 19
COLUMNS = ["block", "seq", "codes", "words", "text_hash"]


def word_blocks(docs: DataFrame, text_col: str = "text", order_col: str = "seq") -> DataFrame:
    """``(block, seq, codes, words, text_hash)``, written: per block of texts a row for each document, its words as codes, and one with the block's distinct words.

    The texts are split once, by Python itself (``py_split`` gives the same words).
    A document's row tells the SHA-256 of its text, so that exact copies are
    found without moving or writing the texts.
    """
    schema = T.StructType().add("block", T.LongType()).add("seq", docs.schema[order_col].dataType)
    schema = schema.add("codes", T.ArrayType(T.IntegerType())).add("words", T.ArrayType(T.StringType())).add("text_hash", T.BinaryType())
    texts = docs.select(order_col, text_col, F.unhex(F.sha2(F.col(text_col), 256)))
    return stage_table(texts.mapInArrow(_coded, schema), "word-blocks", lean=True)


def word_vocab(blocks: DataFrame) -> DataFrame:
    """``(word, id)`` over the distinct words of ``word_blocks``, ranked by the word's bytes."""
    distinct = blocks.select(F.explode("words").alias("word")).distinct()
    ranked, _ = prefix_sums(distinct, "word")
    return ranked.select("word", (F.col("cum_before") + N_SPECIAL).cast("bigint").alias("id"))


def _coded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``word_blocks`` of ``(seq, text, hash)``."""
    block, held, known = TaskContext.get().partitionId() << 32, 0, {}
    seq_type = hash_type = None

    def told() -> pa.RecordBatch:
        words = pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), pa.array(list(known), pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.nulls(1, seq_type), pa.nulls(1, pa.list_(pa.int32())), words, pa.nulls(1, hash_type)], COLUMNS)

    for frame in frames:
        seq_type, hash_type = frame.column(0).type, frame.column(2).type
        length = pc.fill_null(pc.binary_length(frame.column(1)), 0).to_numpy(zero_copy_only=False)
        upto, i = np.cumsum(length, dtype=np.int64), 0
        while i < len(upto):
            rows = max(1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PIECE, "right")) - i)
            split = [(t or "").split() for t in frame.column(1).slice(i, rows).to_pylist()]
            coded = pa.array([w for words in split for w in words], pa.string()).dictionary_encode()
            ends = np.cumsum([0, *map(len, split)])
            place = np.fromiter((known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()), np.int32, len(coded.dictionary))
            codes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[coded.indices.to_numpy(zero_copy_only=False)], pa.int32()))
            own = [pa.array([block] * rows), frame.column(0).slice(i, rows), codes, pa.nulls(rows, pa.list_(pa.string())), frame.column(2).slice(i, rows)]
            yield pa.RecordBatch.from_arrays(own, COLUMNS)
            held += int(upto[i + rows - 1] - (upto[i - 1] if i else 0))
            i += rows
            if held >= BLOCK or len(known) >= MOST:
                yield told()
                block, held, known = block + 1, 0, {}
    if known:
        yield told()


def _decoded(docs: pa.Table, known: pa.Table) -> pa.Table:
    """``(seq, ids)`` of a block's documents from its ``(code, id)`` rows."""
    ids = np.zeros(known.num_rows, np.int64)
    ids[known.column("code").to_numpy()] = known.column("id").to_numpy()
    codes = docs.column("codes").combine_chunks()
    flat = ids[codes.flatten().to_numpy(zero_copy_only=False)]
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy(zero_copy_only=False))])
    return pa.table({"seq": docs.column("seq"), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(pa.int32()))})


def word_ids(docs: DataFrame, blocks: DataFrame, vocab: DataFrame, order_col: str = "seq") -> DataFrame:
    """``(seq, ids)``, written: the words of the documents of ``blocks`` as 32-bit ids, in order.

    The vocabulary is asked for the distinct words of each block of some
    megabytes of text, not for every word: a frequent word is one row a block,
    and documents travel as codes.  Documents without words get ``[]``; the
    words of rows that share a ``seq`` are taken together, by place.  The steps
    are stages, so that the disk holds the shuffles of one of them at a time.
    """
    asked = blocks.where("words is not null").select("block", F.posexplode("words").alias("code", "word"))
    known = stage_table(asked.join(vocab, "word").select(F.col("block").alias("of"), "code", "id"), "word-codes", lean=True)
    own = blocks.where("words is null").select("block", "seq", "codes")
    made = own.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_decoded, T.StructType().add("seq", blocks.schema["seq"].dataType).add("ids", T.ArrayType(T.IntegerType())))
    made = stage_table(made, "word-rows", lean=True)
    drop_stage(known)
    per_doc = made.groupBy("seq").agg(F.collect_list("ids").alias("lists"))
    placed = F.flatten(F.transform("lists", lambda x: F.transform(x, lambda v, i: F.struct(i.alias("pos"), v.alias("id")))))
    together = F.transform(F.array_sort(placed), lambda x: x["id"])
    per_doc = per_doc.select(F.col("seq").alias(order_col), F.when(F.size("lists") == 1, F.col("lists")[0]).otherwise(together).alias("ids"))
    out = docs.select(order_col).join(per_doc, order_col, "left").select(order_col, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    out = stage_table(out, "word-ids", lean=True)
    drop_stage(made)
    return out
