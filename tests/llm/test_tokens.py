import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import documents  # noqa: F401

from kiln.llm import tokens
from kiln.llm.common import utf8, pieces, word_hashes, word_spans

import numpy as np
import pyarrow as pa

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library_on_odd_texts(spark, documents, library):
    random.seed(5)
    pool = ["a", "B", "é", "ß", "1", "½", "_", "-", " ", "  ", "\n", "\t", "'s", "’", "日本", "🙂", " ", " ", "<|endoftext|>", "\x1c", "՘", "don't", "ﬁ"]
    texts = ["".join(random.choices(pool, k=random.randint(0, 40))) for _ in range(400)]
    texts += [None, "", " ", "\n\n\n", "x" * 3000, "word " * 5000, " lead", "trail ", "<|endoftext|>"]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r.doc_id: r.n_tokens for r in tokens.with_token_counts(documents(rows), PATH, frequent=50).collect()}
    assert found == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def test_pieces_do_not_change_counts(library, monkeypatch):
    text = "one two  three\n\n four five " * 300
    whole = tokens.Lengths(PATH, {}).count(text)
    monkeypatch.setattr(tokens, "PIECE", 37)
    assert tokens.Lengths(PATH, {}).count(text) == whole == len(library.encode(text, add_special_tokens=False))


def test_cache_of_any_size_gives_the_same_counts():
    text = " ".join(f"w{i % 97}x{i % 13}" for i in range(2000))
    assert tokens.Lengths(PATH, {}, cache=1).count(text) == tokens.Lengths(PATH, {}).count(text) == tokens.Lengths(PATH, {"w1": 99}, cache=7).count(text)


def test_classes_agree_with_the_library_outside_the_unsure_ones(library):
    cut = tokens.Lengths(PATH, {}).pattern
    for code in [*range(0x3000), *range(0x3000, 0x10000, 37), *range(0x1F300, 0x1F700)]:
        c = chr(code)
        if 0xD800 <= code <= 0xDFFF or tokens.UNSURE.search(c):
            continue
        s = f"a{c}1{c} {c}.{c}  {c}b"
        assert [m.span() for m in cut.finditer(s)] == [x[1] for x in library.pre_tokenizer.pre_tokenize_str(s)], hex(code)


def test_empty_table_repeats_and_other_columns(spark, documents):
    assert tokens.with_token_counts(documents([]), PATH).count() == 0
    rows = documents([(1, "same"), (1, "same"), (2, None)]).withColumn("n_tokens", tokens.F.lit("old")).withColumn("k", tokens.F.lit(3))
    out = tokens.with_token_counts(rows, PATH)
    assert sorted((r.doc_id, r.n_tokens, r.k) for r in out.collect()) == [(1, 1, 3), (1, 1, 3), (2, 0, 3)]


def test_hashes_do_not_depend_on_place_or_piece():
    column = pa.array(["the cat", None, "", "sat the " * 50, "x" * 300])
    offsets, data = utf8(column)
    assert list(np.diff(offsets)) == [7, 0, 0, 400, 300]
    for step in (10, 64, 1 << 20):
        assert b"".join(data[lo:hi].tobytes() for *_, lo, hi in pieces(offsets, data, step)) == data.tobytes()
    raw = np.frombuffer(b"the cat sat the", np.uint8)
    h = word_hashes(raw, *word_spans(raw))
    assert h[0] == h[3] and len(set(h.tolist())) == 3
