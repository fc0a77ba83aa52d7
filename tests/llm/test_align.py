import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from llm_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kiln.llm import align, catalog
from kiln.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b "), (5, "line\nnext \n\tx\x1cy z w"), (6, "<|endoftext|> </s> <unk>"), (7, "▁ under ▁"),
    (8, "naïve ½ ﬁ é 漢字かな 🙂🙂"), (9, "it's we'll 12345 !!!"), (9, "it's we'll 12345 !!!"), (None, "no key here"), (10, "\x00 nul"), (11, "the the the"), (12, " a 　 b\r\n"),
]


def library():
    """Ids and token bytes of both sides, straight from the libraries."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def both(text):
        if not text:
            return [], [], [], []
        e = a.encode(" " + text, add_special_tokens=False)
        ids = b.encode(text)
        ta = [bytes(back[c] for c in t) for t in e.tokens]
        tb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        whole = (" " + text).encode()
        return (e.ids, ids, ta, tb) if b"".join(ta) == b"".join(tb) == whole else ([], [], [], [])

    return both


def brute(rows):
    """Groups cut where both sides end; links of tokens that end together; counts over all."""
    both, told, count = library(), [], Counter()
    for key, text in rows:
        a, b, ta, tb = both(text)
        ends_a, ends_b = ({int(e): i for i, e in enumerate(np.cumsum([len(t) for t in s]))} for s in (ta, tb))
        cuts = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a[c]], b[ends_b[c]]) for c in cuts]
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, a[i : ends_a[c] + 1])) + "|" + ",".join(map(str, b[j : ends_b[c] + 1])))
            i, j = ends_a[c] + 1, ends_b[c] + 1
        count.update(links)
        told.append((key, len(a), len(b), links, groups))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(
        (str(k), na, nb, len(g), len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for k, na, nb, ls, g in told
    )


def got(frame):
    assert frame.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r[0]), *r[1:8]) for r in frame.collect())


@pytest.mark.parametrize("settings", [align.Settings(), align.Settings(piece=40, store=50, block=7)])
def test_odd_texts_equal_brute_force(spark, documents, settings):
    rows = ODD + [(20, "word after word, " * 40), (21, "x" * 3000 + " y"), (22, "tail ▁ " + "long text here " * 30)]
    docs = documents(rows).withColumn("n_a", F.lit("other")).withColumn("row", F.lit(1)).repartition(3)
    assert got(align.alignment(docs, A, B, settings=settings)) == brute(rows)


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    assert got(catalog.op12_alignment(spark, SF001)) == brute(rows)


def test_empty_table(spark, documents):
    assert align.alignment(documents([]), A, B).count() == 0


def test_segments_are_what_the_libraries_encode(spark):
    t = align.Tokenizers(A, B, align.Settings())
    assert t.cuts
    texts = [r.text for r in table(spark, SF001, "documents").collect()] + [x for _, x in ODD if x]
    for text in texts:
        segments = align.SEGMENT.findall(" " + text)
        assert "".join(segments) == " " + text and all(x.startswith(" ") for x in segments)
        slots = t.slots(segments)
        assert t.tokens(slots, 0)[0].tolist() == t.a.encode(" " + text, add_special_tokens=False).ids
        assert t.tokens(slots, 1)[0].tolist() == t.b.encode(text)


def test_terminals_are_connected_components():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, n + 1, rng.integers(1, 30)), n)) for _ in range(2)]
        of = dict(zip("ab", align.terminals(*ends), strict=True))
        spans = {(s, i): set(range(int(lo), int(hi))) for s, e in zip("ab", ends, strict=True) for i, (lo, hi) in enumerate(zip(np.append(0, e[:-1]), e, strict=True))}
        label = {k: k for k in spans}
        for x in sorted(spans):  # merge what overlaps until nothing changes
            for y in spans:
                if spans[x] & spans[y] and label[x] != label[y]:
                    old, new = label[y], label[x]
                    label = {k: new if v == old else v for k, v in label.items()}
        for x in spans:
            for y in spans:
                assert (label[x] == label[y]) == (of[x[0]][x[1]] == of[y[0]][y[1]])
