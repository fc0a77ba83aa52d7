import random

import numpy as np
from llm_fixtures import documents  # noqa: F401

from kiln.llm import superkmer
from kiln.llm.superkmer import Settings


def brute(rows, k=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for j in range(len(w) - k + 1):
            g = tuple(w[j : j + k])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


def run(docs, **kw):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in superkmer.deduplicate(docs, **kw).collect())


def test_equals_brute_force_on_texts_with_shared_passages(spark, documents):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本", "-", "a"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 60]))] for _ in range(12)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(5)):
            text += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(text)))
    rng.shuffle(rows)
    assert run(documents(rows)) == brute(rows)
    assert run(documents(rows), settings=Settings(k=5, m=2, longest=3, parts=2, spread=3)) == brute(rows, 5)


def test_repetitive_texts_copies_and_one_common_passage(spark, documents):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"x{i} {passage} y{i}") for i in range(40)]
    rows += [(100 + i, "a b " * 300) for i in range(3)] + [(200, "a " * 1000), (201, "a " * 12), (202, "a " * 13)]
    assert run(documents(rows)) == brute(rows)


def test_odd_rows(spark, documents):
    long = " ".join(f"q{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, " \n"), (5, long), (5, long), (4, "short text"), (None, long), (None, long + " end")]
    docs = documents(rows).withColumn("kept", superkmer.F.lit(1)).withColumn("block", superkmer.F.lit("b"))
    out = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept, r.carry.kept) for r in superkmer.deduplicate(docs, carry=("kept",), untouched=True).collect()), key=str)
    assert out == sorted(
        [(1, 0, 0, None, 1), (2, 0, 0, "", 1), (3, 0, 0, " \n", 1), (5, 20, 0, long, 1), (5, 20, 0, long, 1), (4, 2, 0, "short text", 1), (None, 20, 20, "", 1), (None, 21, 20, "end", 1)],
        key=str,
    )
    assert run(documents([])) == []


def test_equal_windows_have_one_minimiser_and_every_window_is_covered_once():
    rng = random.Random(1)
    s = Settings(k=7, m=2, longest=4)
    texts = [" ".join(rng.choice("abcdef") for _ in range(200)).encode() for _ in range(5)]
    block = superkmer.Block(texts, s)
    seen = {}
    covered = np.zeros(len(block.hashes), int)
    for i in range(len(block.first)):
        words = block.string(i, s.k).split()
        assert len(words) == block.count[i] + s.k - 1 and block.count[i] <= s.longest
        for w in range(block.count[i]):
            covered[block.first[i] + w] += 1
            assert seen.setdefault(tuple(words[w : w + s.k]), block.minimiser[i]) == block.minimiser[i]
    inside = [block.row[i] == block.row[min(i + s.k - 1, len(block.row) - 1)] and i + s.k <= len(block.row) for i in range(len(block.row))]
    assert (covered == np.array(inside, int)).all()


def test_a_collision_of_window_hashes_is_settled_by_the_words(monkeypatch):
    monkeypatch.setattr(superkmer, "rolled", lambda hashes, width, salt: np.zeros(max(0, len(hashes) - width + 1), np.uint64))
    s = Settings(k=3)
    first, least, _ = superkmer.least_holders([b"a b c d", b"b c d", b"x y z"], np.array([9, 4, 2]), s)
    assert list(first) == [0, 2, 3] and list(least) == [9, 4, 4, 2]
