from pyspark.sql import functions as F

from kiln.operators import vocab

TEXTS = [(0, "b a b　b"), (1, None), (2, ""), (3, " \x1c c a "), (4, "a " * 500), (5, "x y"), (5, "x y"), (None, "q")]


def ids_of(spark, rows):
    docs = spark.createDataFrame(rows, "seq long, text string").repartition(2)
    blocks = vocab.word_blocks(docs)
    return blocks, vocab.word_ids(docs, blocks, vocab.word_vocab(blocks))


def test_word_ids_are_ranks_of_the_words(spark):
    blocks, out = ids_of(spark, TEXTS)
    rank = {w: 4 + i for i, w in enumerate(sorted({w for _, t in TEXTS for w in (t or "").split()}))}
    want = [(k, [] if k is None else [rank[w] for w in (t or "").split()]) for k, t in TEXTS if k != 5]
    want += 2 * [(5, [rank["x"]] * 2 + [rank["y"]] * 2)]  # rows of one key are taken together, by place
    assert sorted(((r.seq, list(r.ids)) for r in out.collect()), key=str) == sorted(want, key=str)


def test_a_block_asks_for_a_word_once(spark):
    rows = [(i, "the same few words") for i in range(300)]
    blocks, out = ids_of(spark, rows)
    asked = blocks.select("block", F.explode("words").alias("w"))
    assert asked.count() == asked.distinct().count() == 4 * blocks.select("block").distinct().count() <= 8
    assert {tuple(r.ids) for r in out.collect()} == {(6, 5, 4, 7)}
