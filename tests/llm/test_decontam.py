import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
from llm_fixtures import documents  # noqa: F401

from kiln.llm import decontam


def make(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmno", k=rng.randint(2, 9))) for _ in range(4000)]
    common = vocabulary[:40]
    draw = lambda k: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(k)]
    items = [(i, " ".join(draw(rng.randint(15, 60)))) for i in range(30)]
    docs = [(i, " ".join(draw(rng.randint(5, 700)))) for i in range(n)]
    return rng, draw, items, docs


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def found(docs, bench, **kw):
    return {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench, **kw).collect()}


def test_verbatim_and_reworded_items_are_found_and_clean_texts_are_not(spark, documents):
    rng, draw, items, docs = make()
    want = set()
    for i in range(0, 60, 3):
        item, words = i % 30, docs[i][1].split()
        told = items[item][1].split()
        if i % 2:  # every eighth word replaced, case and punctuation changed
            told = [w if j % 8 != 3 or j >= len(told) * 3 // 4 else "zz" for j, w in enumerate(told)]
            told = [w.upper() + "," for w in told]
        at = rng.randrange(len(words) + 1)
        docs[i] = (i, " ".join(words[:at] + told + words[at:]))
        want.add((i, item))
    assert found(documents(docs), benchmark(spark, items)) == want


def test_blocks_of_items_give_the_same(spark, documents):
    _, _, items, docs = make(5, 20)
    docs[4] = (4, docs[4][1] + " " + items[2][1])
    docs[9] = (9, items[17][1])
    small = decontam.Settings(block=8)
    assert found(documents(docs), benchmark(spark, items), settings=small) == {(4, 2), (9, 17)}


def brute(docs, items, s=decontam.Settings()):
    """Every stretch of every document against every item, by the plain table of the common subsequence."""

    def common(a, b):
        line = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(line[j] + 1 if x == y else max(line[j + 1], new[j]))
            line = new
        return line[-1]

    clean = lambda t: [w for w in re.split(r"[^\w]+", t.lower()) if w]
    out = set()
    for key, text in docs:
        words = clean(text)
        for name, told in items:
            item = clean(told)
            close, width, own = item[-max(3, len(item) // 4) :], len(item) + len(item) // 2, set(item)
            for at in range(max(1, len(words) - width + 1)):
                stretch = words[at : at + width]
                if sum(w in own for w in stretch) < s.paraphrase * len(item):
                    continue
                long = common(stretch, item) / len(item)
                if long >= s.verbatim or long >= s.paraphrase and common(stretch, close) / len(close) >= s.answer:
                    out.add((key, name))
                    break
    return out


def reworded(rng, words, share):
    """Words before the answer replaced."""
    told, close = list(words), max(3, len(words) // 4)
    for j in rng.sample(range(len(told) - close), int(share * len(told))):
        told[j] = f"new{j}"
    return told


def planted(seed=21, n=60):
    """Documents with verbatim, reworded, scrambled and cut items."""
    rng, draw, items, docs = make(seed, n)
    for i in range(n):
        words, told = docs[i][1].split(), items[i % 30][1].split()
        kind = i % 6
        if kind < 5:
            told = [told, reworded(rng, told, 0.15), reworded(rng, told, 0.3), reworded(rng, told, 0.5), rng.sample(told, len(told))][kind]
            at = rng.randrange(len(words) + 1)
            docs[i] = (i, " ".join(words[:at] + told + words[at:]))
    return rng, items, docs


def test_the_leaks_equal_brute_force(spark, documents):
    _, items, docs = planted()
    want = brute(docs, items)
    assert 25 <= len(want) < 50
    assert found(documents(docs), benchmark(spark, items)) == want
    several = decontam.Settings(block=8, room=1 << 16)  # a pass for each few blocks
    assert found(documents(docs), benchmark(spark, items), settings=several) == want


def test_cosine_finds_paraphrases_and_needs_its_basis(spark, documents, monkeypatch):
    _, items, docs = planted(22, 120)
    want = brute(docs, items)
    args = documents(docs), benchmark(spark, items)
    by = {(r.doc_id, r.item_id): r.found_by for r in decontam.leaks(*args).collect()}
    assert by.keys() == want and sum(v == "cosine" for v in by.values()) >= 0.9 * len(want)
    real = decontam.latent_space

    def chance(*given):
        buckets, basis, columns = real(*given)
        rng = np.random.default_rng(1)
        columns = rng.normal(size=columns.shape)
        return buckets, rng.normal(size=basis.shape).astype(np.float32), (columns / np.linalg.norm(columns, axis=0)).astype(np.float32)

    monkeypatch.setattr(decontam, "latent_space", chance)
    lost = {(r.doc_id, r.item_id): r.found_by for r in decontam.leaks(*args).collect()}
    assert sum(v == "cosine" for v in lost.values()) < 0.3 * len(want)


def test_a_paraphrase_beside_its_scrambled_words_is_found(spark, documents):
    rng, draw, items, _ = make(31, 1)
    told = items[3][1].split()[:20]
    said = [w if j not in (2, 5, 8, 11) else f"new{j}" for j, w in enumerate(told)]
    text = " ".join(draw(40) + said + draw(6) + rng.sample(told, 20) + draw(40))
    assert found(documents([(1, text)]), benchmark(spark, [(3, " ".join(told)), *items[4:]])) == {(1, 3)}
    item = np.arange(20, dtype=np.uint64)
    region = np.concatenate([item[[0, 1, 3, 4, 6, 7, 9, 10, 12, 13, 14, 15, 16, 17, 18, 19]], np.arange(50, 56, dtype=np.uint64), item[::-1]])
    assert decontam.confirm(region, item, item[-5:], decontam.Settings())[2]


def test_long_documents_and_items_are_searched_whole(spark, documents):
    rng, draw, items, _ = make(41, 1)
    long = draw(3000)
    words = draw(400_000)
    text = " ".join(words[:350_000] + items[2][1].split() + words[350_000:] + reworded(rng, long, 0.2))
    assert len(text) > 2 << 20
    assert found(documents([(1, text), (2, " ".join(words[:5000]))]), benchmark(spark, [*items, (99, " ".join(long))])) == {(1, 2), (1, 99)}


def test_odd_rows(spark, documents):
    _, _, items, docs = make(7, 10)
    rows = [*docs, (100, None), (101, ""), (102, "..."), (103, items[0][1]), (103, items[0][1]), (None, items[1][1])]
    bench = benchmark(spark, [*items, (90, None), (91, ""), (92, "!!"), (93, items[0][1])])
    out = decontam.leaks(documents(rows).withColumn("item_id", decontam.F.lit(5)), bench.withColumn("doc_id", decontam.F.lit(1)))
    got = sorted(((r.doc_id, r.item_id) for r in out.collect()), key=str)
    assert got == sorted([(103, 0), (103, 0), (103, 93), (103, 93), (None, 1)], key=str)
    assert found(documents([]), bench) == set()
    assert found(documents(docs), benchmark(spark, [])) == set() == found(documents(docs), benchmark(spark, [(1, None)]))


def test_short_items_must_occur_as_they_are():
    s, w = decontam.Settings(), np.arange(1, 40, dtype=np.uint64)
    assert decontam.confirm(w, w[5:9], w[6:9], s)[2]
    assert not decontam.confirm(w, w[[5, 6, 8]], w[[8]], s)[2]


def test_a_paraphrase_needs_its_answer():
    s = decontam.Settings()
    item = np.arange(20, dtype=np.uint64)
    region = np.concatenate([item[:14], np.arange(100, 106, dtype=np.uint64)])
    share, told, leak = decontam.confirm(region, item, item[-5:], s)
    assert (share, told, leak) == (0.7, 0.0, False)
    region = np.concatenate([item[:9], np.arange(100, 106, dtype=np.uint64), item[-5:]])
    share, told, leak = decontam.confirm(region, item, item[-5:], s)
    assert (share, told, leak) == (0.7, 1.0, True)


def test_common_subsequence_equals_the_table():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == table[-1][-1]


def test_paraphrases_without_their_rare_words_are_found_among_2000_items(spark, documents):
    """A third of an item's words before its answer go, the rarest of the corpus first."""
    rng = random.Random(11)
    common, rare = ([f"{c}{i}" for i in range(n)] for c, n in (("c", 150), ("r", 30_000)))
    draw = lambda k: [rng.choice(common) if rng.random() < 0.7 else rng.choice(rare) for _ in range(k)]
    items = [draw(rng.randint(15, 59)) for _ in range(2_000)]
    docs, want = [], set()
    for i in range(80):
        words = draw(rng.randint(100, 400))
        if i % 2:
            item = rng.randrange(len(items))
            told, close = list(items[item]), max(3, len(items[item]) // 4)
            order = sorted(range(len(told) - close), key=lambda j: (told[j][0] == "c", rng.random()))
            for j in order[: int(0.3 * len(told))]:
                told[j] = f"new{j}"
            at = rng.randrange(len(words) + 1)
            words = words[:at] + told + words[at:]
            want.add((i, item))
        docs.append((i, " ".join(words)))
    bench = benchmark(spark, [(i, " ".join(w)) for i, w in enumerate(items)])
    assert want <= found(documents(docs), bench)


def test_the_latent_space_is_that_of_all_passages(spark, documents, monkeypatch):
    """More documents than any sample: the basis spans the leading eigenvectors of all passages and items."""
    rng = random.Random(4)
    names = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    texts = [" ".join(rng.choices(names, weights, k=rng.randint(1, 50))) for _ in range(2_600)]
    items = [(i, " ".join(rng.sample(names, 10))) for i in range(12)]
    clean = [t.split() for t in texts]
    df = {w: sum(w in t for t in clean) for w in names}
    used = sorted({w for _, t in items for w in t.split()})
    idf = np.array([max(0.05, np.log((len(texts) + 1) / (df[w] + 0.5))) for w in used])

    def unit(words):
        row = np.array([w in words for w in used]) * idf
        return row / max(np.linalg.norm(row), 1e-12)

    halves = [unit(set(t[i : i + 32])) for t in clean for i in range(0, len(t), 32)]
    a, b = np.array([r for r in halves if r.any()]), np.array([unit(set(t.split())) for _, t in items])
    s = decontam.Settings(rank=3, extra=8, power=12)
    value, vector = np.linalg.eigh(a.T @ a + len(a) / len(items) * b.T @ b)
    assert value[-3] > 1.02 * value[-4]
    want = vector[:, -3:] @ vector[:, -3:].T
    bench = benchmark(spark, items).selectExpr("item_id i", "text t", "cast(null as string) a", "0 block")
    for most in (4096, 8):  # from the Gram matrix, and from the passages
        monkeypatch.setattr(decontam, "GRAM", most, raising=False)
        (space,) = decontam.passes(bench, documents(list(enumerate(texts))).selectExpr("text t"), s)
        hashes, rows = decontam.folded(decontam.pa.array(used))
        own = space.slot[decontam._bucket(hashes[np.argsort(rows)], s.bits)]
        basis = space.blocks[0].basis[space.blocks[0].row_of[own]] / idf[:, None]
        assert np.abs(basis @ basis.T - want).max() < 1e-4


class Steps:
    """A table that keeps the functions a plan would run."""

    def __init__(self):
        self.made = []
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def mapInArrow(self, function, schema):  # noqa: N802
        self.made.append(function)
        return self

    def select(self, *columns):
        return self

    repartition = sortWithinPartitions = select  # noqa: N815


def test_a_task_of_the_gram_matrix_stays_small(monkeypatch):
    rng, terms, steps = np.random.default_rng(4), 3_000, Steps()
    monkeypatch.setattr(decontam, "written", lambda df, what: df)
    idf = rng.random(terms) + 0.5
    place = np.full(terms + 500, -1, np.int32)  # terms of other blocks are left out
    place[np.sort(rng.choice(len(place), terms, replace=False))] = np.arange(terms)
    decontam.gram(steps, place, idf)
    multiply, add = steps.made

    def frame(halves):
        ids = np.concatenate([*halves, np.zeros(0)]).astype(np.int32).tobytes()
        ends = np.cumsum([len(h) for h in halves]).astype(np.int32).tobytes()
        return decontam._told_row([ids, b""], [ends, b""], [None, None])

    told = [[np.sort(rng.choice(len(place), rng.integers(1, 33), replace=False)) for _ in range(1024)] for _ in range(12)]
    list(multiply(iter([])))  # what is imported and kept once
    tracemalloc.start()
    parts = [p for t in (told[:6], told[6:]) for p in multiply(frame(h) for h in t)]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 90 << 20  # the packed triangle takes 36 MB, the square 72 MB
    parts.sort(key=lambda p: p.column("c")[0].as_py())
    got = np.zeros((terms, terms))
    for stripe in add(iter(parts)):
        c, v = stripe.column("c")[0].as_py(), np.frombuffer(stripe.column("v")[0].as_py()).reshape(-1, terms)
        got[c : c + len(v)] = v
    a = np.zeros((12 * 1024, terms))
    for i, half in enumerate(h for t in told for h in t):
        own = place[half][place[half] >= 0]
        a[i, own] = idf[own]
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    assert np.abs(got + got.T - a.T @ a).max() < 1e-5
