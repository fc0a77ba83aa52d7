from llm_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F

from kiln.llm import catalog, langid
from kiln.llm.common import learnable, table

SMALL = langid.Settings(bits=12, per_language=60, epochs=3, steps=300)


def test_held_out_accuracy_and_columns(spark):
    rows = catalog.op6_language(spark, SF001)
    assert rows.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = table(spark, SF001, "documents").select("doc_id", "lang")
    judged = rows.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score"), F.count_if("rejected")).first()
    assert judged[0] >= 0.97 and 0.5 <= judged[1] <= judged[2] <= 1 and judged[3] == 0


def test_odd_texts_are_unknown_and_columns_pass(spark, documents):
    docs = table(spark, SF001, "documents")
    model = langid.train(docs.where(learnable("doc_id", 4, 2)), settings=SMALL)
    odd = documents([(1, None), (2, ""), (3, "123 456 !!!"), (4, "\n\n"), (4, "½ ² Ⅳ ①"), (5, "the the the"), (5, "the the the"), (None, "der die das")])
    out = langid.with_language(odd.withColumn("score", F.lit("old")).withColumn("language", F.lit(1)), model)
    rows = [(r.doc_id, r.language.lang, r.language.rejected, r.score) for r in out.collect()]
    assert {r[1:3] for r in rows if r[0] in (1, 2, 3, 4)} == {("und", True)}
    assert [r for r in rows if r[0] == 5][0] == [r for r in rows if r[0] == 5][1]
    assert all(r[3] == "old" for r in rows)
    assert langid.with_language(documents([]), model).count() == 0


def test_nothing_to_learn_gives_unknown(spark, documents):
    model = langid.train(documents([(1, "no label here"), (2, None, "en")]), settings=SMALL)
    out = langid.with_language(documents([(1, "some text")]), model).first()
    assert (out.language.lang, out.language.score, out.language.rejected) == ("und", 0.0, True)


def test_score_does_not_depend_on_batch_or_length_steps(spark):
    import numpy as np
    import pyarrow as pa

    model = langid.train(table(spark, SF001, "documents"), settings=SMALL)
    texts = pa.array(["der und die " * 10, "", None, "the of and " * 200_000, "el la los"])
    together = langid.logits(model, texts)
    alone = np.vstack([langid.logits(model, texts.slice(i, 1)) for i in range(5)])
    assert np.allclose(together, alone, atol=1e-4)


def test_rejection_level_is_learned():
    import numpy as np

    p = np.array([[0.9, 0.05, 0.05], [0.2, 0.6, 0.2], [0.5, 0.3, 0.2], [0.4, 0.3, 0.3]])
    level = langid.rejection_level(p, np.array([0, 1, 0, 2]), 0.0)  # the last is wrong
    assert abs(level - (1 / 3 + 0.5) / 2) < 1e-12
    assert langid.rejection_level(p[3:], np.array([2]), 0.0) == 1 / 3


def test_scores_equal_a_sum_over_subwords_one_by_one(spark):
    import numpy as np
    import pyarrow as pa

    model = langid.train(table(spark, SF001, "documents"), settings=SMALL)
    none, shift = 1 << model.bits, 32 - model.bits
    fold = lambda c: 0x20 if c < 0x21 else c + 32 if 0x41 <= c < 0x5B else 0x30 if 0x30 <= c < 0x3A else c

    def brute(text):
        raw = bytes(fold(c) for c in b" " + text.encode() + b" ")
        at = []
        for i in range(len(raw)):
            if i + 2 < len(raw) and raw[i + 1] != 0x20:
                at.append((int.from_bytes(raw[i : i + 3], "little") * 2654435761 & 0xFFFFFFFF) >> shift)
            if i + 3 < len(raw) and 0x20 not in raw[i + 1 : i + 3]:
                h = int.from_bytes(raw[i : i + 4], "little")
                at.append(((h ^ h >> 15) * 2246822519 & 0xFFFFFFFF) >> shift)
        assert none not in at
        return model.table[at].astype(float).sum(axis=0) / max(1, len(at)) + model.bias

    texts = ["Der Hund und 42 Katzen", "la", "été à Paris", "x"]
    assert np.allclose(langid.logits(model, pa.array(texts)), [brute(t) for t in texts], atol=1e-5)
