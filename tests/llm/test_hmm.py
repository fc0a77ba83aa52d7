import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
from llm_fixtures import documents  # noqa: F401

from kiln.llm import hmm
from kiln.llm.common import held_out, learnable

SMALL = hmm.Settings(states=3, common=20, classes=8, sample=50, warm=3, rounds=2)


def random_model(rng, states=3, width=5):
    draw = lambda *n: rng.dirichlet(np.ones(n[-1]), n[:-1] or None)
    return hmm.Model(draw(states), draw(states, states), draw(states, width).T)


def paths(model, sequence):
    """Probability of every state path with the sequence."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]]
        for t, (s, o) in enumerate(zip(path, sequence)):
            p *= model.emit[o, s] * (model.move[path[t - 1], s] if t else 1)
        yield path, p


def test_forward_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    model = random_model(rng)
    sequences = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 6, 3, 6, 2)]
    want = [math.log10(sum(p for _, p in paths(model, x))) for x in sequences]
    assert np.allclose(hmm.forward(model, sequences, 7), want) and np.allclose(hmm.forward(model, sequences, 10**6), want)


def test_expected_counts_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(2)
    model = random_model(rng)
    s = hmm.Settings(states=3, common=3, classes=2, group=1000)
    sequences = [rng.integers(0, 5, n).astype(np.uint16) for n in (4, 1, 5)]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for x in sequences:
        total = sum(p for _, p in paths(model, x))
        for path, p in paths(model, x):
            start[path[0]] += p / total
            for t, (state, o) in enumerate(zip(path, x)):
                emit[o, state] += p / total
                if t:
                    move[path[t - 1], state] += p / total
    found = hmm.expected(model, sequences, s)
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(found, (start, move, emit)))


def test_long_sequences_count_whole_in_bounded_pieces():
    """A text beyond ``group`` tokens gives the counts it gives in one piece, whatever the bound."""
    rng = np.random.default_rng(4)
    model = random_model(rng)
    sequences = [rng.integers(0, 5, n).astype(np.uint16) for n in (40, 3, 57, 12)]
    whole = hmm.expected(model, sequences, hmm.Settings(states=3, common=3, classes=2, group=1000))
    for group in (1, 5, 12, 56):
        cut = hmm.expected(model, sequences, hmm.Settings(states=3, common=3, classes=2, group=group))
        assert all(np.allclose(a, b, rtol=1e-3, atol=1e-3) for a, b in zip(whole, cut, strict=True))
        assert abs(cut[1].sum() - sum(len(x) - 1 for x in sequences)) < 1e-2 and abs(cut[0].sum() - 4) < 1e-3


def test_rounds_raise_the_likelihood(spark):
    rng = np.random.default_rng(3)
    s = hmm.Settings(states=2, common=6, classes=2, prior=0.01)
    sequences = [rng.integers(0, 4, 40).astype(np.uint16) + 4 * (i % 2) for i in range(60)]
    rows = spark.createDataFrame([(x.tobytes(),) for x in sequences], "classes binary").repartition(5)
    totals = np.bincount(np.concatenate(sequences), minlength=8).astype(float)
    model, likely = hmm.first_model(totals, s), []
    for _ in range(8):
        likely.append(hmm.forward(model, sequences, 10**6).sum())
        model = hmm.baum_welch(rows, model, totals, s)
    assert all(b > a - 0.5 for a, b in zip(likely, likely[1:])) and likely[-1] > likely[0] + 100


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    plain = hmm.Block([b"b a b c", b"c"], 4)
    monkeypatch.setattr(hmm, "long_word_hashes", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    block = hmm.Block([b"b a b c", b"c"], 4)
    assert sorted(block.words) == sorted(plain.words) == [b"\n", b"a", b"b", b"c"]
    assert [block.words[i] for i in block.ids] == [plain.words[i] for i in plain.ids] == [b"b", b"a", b"b", b"c", b"\n", b"c", b"\n"]


def texts(n=150, seed=1):
    rng = random.Random(seed)
    words = [["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(120)] for letters in ("abcdE", "vwxyz")]
    return [(i, " ".join(rng.choice(words[i % 2]) for _ in range(rng.randrange(60)))) for i in range(n)]


def test_base_score_and_counts_equal_brute_force(spark, documents):
    rows = [*texts(), (1000, None), (1001, ""), (1002, " \n "), (1003, "never seen WORDS é x")]
    found = {r.doc_id: r for r in hmm.score(documents(rows), learnable("doc_id", 7, 2), held_out("doc_id", 7, 2), settings=SMALL).collect()}
    tokens = {i: (t or "").encode().lower().split() + ["end"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_the_model_is_a_distribution_over_words(spark, documents):
    """Over texts of one token before the end, probabilities of all known words and one unseen per class add up to the chance of one."""
    rows = [(i, w) for i, w in enumerate("a b c d e f g aa bb cc dd".split())] + [(50, "a a b")]
    s = hmm.Settings(states=2, common=3, classes=2, warm=2, rounds=1)
    train = documents(rows)
    words = sorted({w for _, t in rows for w in t.split()})
    unseen, k = {}, 0
    while len(unseen) < 2:
        w = f"zz{k}"
        unseen.setdefault(hmm.word_class(w.encode(), 2), w)
        k += 1
    probe = [(100 + i, w) for i, w in enumerate([*words, *unseen.values()])]
    both = documents([*rows, *probe])
    found = {r.doc_id: r.score for r in hmm.score(both, hmm.F.col("doc_id") < 100, hmm.F.lit(False), settings=s).collect()}
    one = sum(10 ** found[i] for i, _ in probe)
    assert 0 < one < 1 and train.count() == len(rows)


def test_odd_tables(spark, documents):
    rows = documents([(1, "a b"), (1, "a b"), (None, "a"), (2, "x " * 30_000)]).withColumn("score", hmm.F.lit("old")).withColumn("block", hmm.F.lit(1))
    out = hmm.score(rows, learnable("doc_id", 7, 2), held_out("doc_id", 7, 2), settings=SMALL).collect()
    assert len(out) == 4 and len({r.score for r in out if r.doc_id == 1}) == 1
    assert hmm.score(documents([]), hmm.F.lit(True), hmm.F.lit(False), settings=SMALL).count() == 0
    none = hmm.score(documents([(1, "a")]), hmm.F.lit(False), hmm.F.lit(True), settings=SMALL).first()
    assert (none.train_tokens, none.n_known, none.base_score) == (0, 0, 0.0) and none.score <= 0
