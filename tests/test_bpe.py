import json
import random

import pytest
from pyspark.sql import functions as F

from kiln.config import TokenizerConfig
from kiln.operators import bpe
from kiln.operators import bpe_train
from kiln.operators.bpe_train import Learned, Phases, merge_runs
from kiln.plans.tables import kept

from conftest import SF001, SF01


def public(texts, cfg):
    """The public trainer's tokenizer for the same settings."""
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel
    from tokenizers.trainers import BpeTrainer

    tok = Tokenizer(BPE(unk_token="<unk>"))
    tok.pre_tokenizer = ByteLevel()
    trainer = BpeTrainer(
        vocab_size=cfg.vocab_size, min_frequency=cfg.min_frequency, special_tokens=list(cfg.special_tokens),
        max_token_length=cfg.max_token_length, initial_alphabet=ByteLevel.alphabet(), show_progress=False,
    )
    tok.train_from_iterator(texts, trainer=trainer)
    return tok


def same_merges(model, tok):
    theirs = [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    return [(model.token_string(a), model.token_string(b)) for a, b, _ in model.merges] == theirs


def test_the_default_vocabulary_equals_the_public_trainer(spark):
    """All 16,000 tokens, in a few phases."""
    docs = kept(spark, SF01).select("seq", "text")
    model = bpe.train_bpe(docs)
    tok = public([r.text for r in docs.orderBy("seq").collect()], TokenizerConfig())
    assert model.vocab_size == 16_000 and model.rounds < 150
    assert {model.token_string(i): i for i in range(16_000)} == tok.get_vocab() and same_merges(model, tok)


@pytest.mark.parametrize("phases", [Phases(), Phases(first=1, hot=4, runs=6), Phases(first=8, hot=8, runs=40), Phases(first=200, hot=400, runs=100_000)])
def test_any_bounds_of_a_phase_give_the_same_merges(spark, phases):
    """Small alphabets make runs of equal symbols, ties, and tokens that are spelled in two ways."""
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") if rng.random() < 0.7 else rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    cfg = TokenizerConfig(vocab_size=330, max_token_length=6)
    assert same_merges(bpe.train_bpe(docs, cfg, phases=phases), public(texts, cfg))


def test_merging_inside_runs_equals_a_full_recount():
    rng = random.Random(1)
    for _ in range(60):
        runs = [[rng.randrange(4) for _ in range(rng.randint(2, 9))] for _ in range(12)]
        counts = [rng.randint(1, 5) for _ in runs]
        tokens = [bytes([97 + i]) for i in range(4)]
        plain, ours = [list(r) for r in runs], Learned(list(tokens), {t: i for i, t in enumerate(tokens)})
        merge_runs(runs, counts, ours, 3, 5, 20)
        check = Learned(list(tokens), {t: i for i, t in enumerate(tokens)})
        while len(check.tokens) < 20:
            total = {}
            for r, n in zip(plain, counts, strict=True):
                for p in zip(r[:-1], r[1:], strict=True):
                    total[p] = total.get(p, 0) + n
            best = min((p for p in total if total[p] >= 3 and check.fits(*p, 5)), key=lambda p: (-total[p], p), default=None)
            if best is None:
                break
            new, known = check.merge(*best)
            for i, r in enumerate(plain):
                out = []
                for x in r:
                    if out and (out[-1], x) == best:
                        out[-1] = new
                    else:
                        out.append(x)
                plain[i] = out
            if known:
                break
        assert ours.merges == check.merges


def test_training_matches_public_trainer(spark):
    docs = kept(spark, SF001).select("seq", "text")
    cfg = TokenizerConfig(vocab_size=330)
    model = bpe.train_bpe(docs, cfg)
    texts = [r.text for r in docs.orderBy("seq").collect()]
    tok = public(texts, cfg)
    ours = {model.token_string(i): i for i in range(model.vocab_size)}
    assert ours == tok.get_vocab()
    enc = bpe.encode_documents(docs, model).orderBy("seq").collect()
    for r, t in zip(enc, texts):
        assert list(r.ids) == tok.encode(t).ids


def test_round_trip_and_unseen_bytes(spark):
    train = spark.createDataFrame([(0, "hello hello world world"), (1, "hello there")], "seq long, text string")
    model = bpe.train_bpe(train, TokenizerConfig(vocab_size=280))
    probe = spark.createDataFrame([(0, "héllo ☃ 😀 unseen\x00bytes"), (1, ""), (2, " lead")], "seq long, text string")
    enc = bpe.encode_documents(probe, model)
    dec = {r.seq: r.text for r in bpe.decode_documents(enc, model).collect()}
    assert dec == {0: " héllo ☃ 😀 unseen\x00bytes", 1: "", 2: " lead"}
    counts = {r.seq: r.n_tokens for r in bpe.token_counts(probe, model).collect()}
    assert counts == {r.seq: len(r.ids) for r in enc.collect()}
    told = bpe.contract(model.vocab_frame(spark), model.merges_frame(spark), enc, TokenizerConfig(vocab_size=280)).first()
    assert told.contract_ok and told.vocab_size == model.vocab_size
    broken = model.vocab_frame(spark).where("token <> '<eos>'")
    assert not bpe.contract(broken, model.merges_frame(spark), enc, TokenizerConfig(vocab_size=280)).first().contract_ok


def test_overlong_pairs_do_not_end_training(spark):
    """More overlong pairs than a phase holds are the most frequent for ever; the rest is still merged."""
    text = " ".join(["abababab cdcdcdcd efefefef"] * 50 + ["xy"] * 5)
    train = spark.createDataFrame([(0, text)], "seq long, text string")
    cfg = TokenizerConfig(vocab_size=400, max_token_length=2)
    for phases in (Phases(first=1, hot=1), Phases(first=2, hot=2), Phases()):
        assert len(bpe.train_bpe(train, cfg, phases=phases).merges) == 4  # ab, cd, ef, xy


def test_cut_and_special_ids_decode(spark):
    train = spark.createDataFrame([(0, "hello hello")], "seq long, text string")
    model = bpe.train_bpe(train, TokenizerConfig(vocab_size=262))
    lead = model.byte_ids[0xC3]
    ids = spark.createDataFrame([(0, [2]), (1, [lead]), (2, None), (3, [2, model.byte_ids[ord("a")], 0])], "seq long, ids array<int>")
    assert {r.seq: r.text for r in bpe.decode_documents(ids, model).collect()} == {0: "", 1: "\ufffd", 2: "", 3: "a"}


def test_long_pretokens_merge_like_rescanning(spark):
    train = spark.createDataFrame([(0, "abcabcabd aabbaabb " * 20)], "seq long, text string")
    model = bpe.train_bpe(train, TokenizerConfig(vocab_size=290))
    encoder = bpe.Encoder(model)

    def rescan(ids):
        while True:
            ranked = [(encoder.ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in encoder.ranks]
            if not ranked:
                return ids
            i = min(ranked)[1]
            ids = ids[:i] + [encoder.ranks[ids[i], ids[i + 1]][1]] + ids[i + 2 :]

    for word in (" aabbaabbaabb", "abcabdabcabc" * 9, "aaaa", "b"):
        ids = [model.byte_ids[b] for b in word.encode()]
        assert encoder.merge(list(ids)) == rescan(ids)


def test_batch_encoding_equals_one_merge_at_a_time():
    """Random models with runs of equal symbols; words short and long, empty ones, repeated ones."""
    import pyarrow as pa

    rng = random.Random(6)
    for _ in range(30):
        tokens, merges = [b"", b"", b"", b""] + [bytes([b]) for b in range(256)], []
        byte_ids = [4 + b for b in range(256)]
        ids = [byte_ids[c] for c in b"abc"]
        while len(merges) < rng.randint(0, 25):
            a, b = rng.choice(ids), rng.choice(ids)
            if (a, b) not in {m[:2] for m in merges}:
                tokens.append(tokens[a] + tokens[b])
                ids.append(len(tokens) - 1)
                merges.append((a, b, len(tokens) - 1))
        model = bpe.BPEModel(tokens, ("<pad>", "<bos>", "<eos>", "<unk>"), byte_ids, merges)
        words = ["".join(rng.choice("aabc") for _ in range(rng.choice([0, 1, 2, 5, 9, 40, 300]))) for _ in range(40)]
        words += words[:5] + ["aaaaaaa", "é"]
        batch, single = bpe.BatchEncoder(model), bpe.Encoder(model)
        flat, size = batch(pa.array(words))
        want = [single.merge([byte_ids[x] for x in w.encode()]) for w in words]
        assert size.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_encoding_slices_by_size_and_takes_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    model = bpe.train_bpe(spark.createDataFrame([(0, "hello hello world")], "seq long, text string"), TokenizerConfig(vocab_size=270))
    rows = [(0, "hello world " * 30), (1, None), (2, ""), (3, "x" * 2000), (4, "hello")]
    docs = spark.createDataFrame(rows, "seq long, text string").coalesce(1)
    got = {r.seq: r.ids for r in bpe.encode_documents(docs, model).collect()}
    alone = {i: bpe.encode_documents(docs.where(F.col("seq") == i), model).first().ids for i in range(5)}
    assert got == alone and got[1] == [] == got[2] and len(got[3]) > 1
    assert {r.seq: r.n_tokens for r in bpe.token_counts(docs, model).collect()} == {k: len(v) for k, v in got.items()}


def test_runs_of_one_pair_are_not_cut(spark):
    """Equal symbols make a run of each length, more than a phase asks for; all of them are merged."""
    texts = [" ".join("a" * n for n in range(1, 30)) + " b"]
    docs = spark.createDataFrame(list(enumerate(texts * 3)), "seq long, text string")
    cfg = TokenizerConfig(vocab_size=270)
    assert same_merges(bpe.train_bpe(docs, cfg, phases=Phases(first=1, hot=1, runs=2)), public(texts * 3, cfg))


def test_the_ranking_and_the_runs_reach_the_driver_in_order_and_whole(spark):
    counts = spark.range(0, 40_000, 1, 16).selectExpr("id as pair", "id % 7 as c").repartition(16)
    want = sorted(((i, i % 7) for i in range(40_000)), key=lambda x: (-x[1], x[0]))
    assert [tuple(x) for x in bpe_train.ranking(counts, 500)] == want[:500]
    assert [tuple(x) for x in bpe_train.ranking(counts, 50_000)] == want
    assert bpe_train.ranking(counts.where("c > 7"), 5) == []
    assert sorted(bpe_train.gathered(counts)["pair"].to_pylist()) == list(range(40_000))


def test_ids_leave_a_task_piece_by_piece(spark, monkeypatch):
    model = bpe.BPEModel([bytes([i]) for i in range(256)], (), list(range(256)), [])
    monkeypatch.setattr(bpe, "PIECE", 10)
    words = bpe.pa.array([["abc", " de"], [], None, [" fghijklmnop"], ["q"]])
    for counts in (False, True):
        told = list(bpe._encoded(model, counts).func(iter([words, words.slice(0, 0)])))
        assert len(told) > 1 and all(len(t) < len(words) for t in told)
        whole = bpe.pa.concat_arrays(told).to_pylist()
        want = [list(b"abc de"), [], [], list(b" fghijklmnop"), list(b"q")]
        assert whole == ([len(x) for x in want] if counts else want)


def test_counts_runs_and_texts_are_gathered_in_bulk():
    """Sums by key, runs cut from the symbols and spelled ids equal a loop over them."""
    import numpy as np
    import pyarrow as pa

    from kiln.operators.bpe import Spelled
    from kiln.operators.bpe_train import Sums, _arrays, _cut, _frame

    frame = _frame(np.array([5, 7, 1]), np.array([2, 0, 3]), np.array([1, 2, 3, 4, 5], np.int32))
    cnt, size, flat = _arrays(frame.slice(1))
    assert (cnt.tolist(), size.tolist(), flat.tolist()) == ([7, 1], [0, 3], [3, 4, 5])
    runs = _cut(flat, np.array([0, 1]), np.array([2, 3])).to_pylist()
    assert [np.frombuffer(r, np.int32).tolist() for r in runs] == [[3, 4], [4, 5]]
    total = Sums("run", pa.binary())
    for _ in range(3):
        total.add(pa.array([b"x", b"y", b"x"]), np.array([1, 2, 3]))
    assert dict(zip(*(c.to_pylist() for c in total.told().columns), strict=True)) == {b"x": 12, b"y": 6}
    spelled = Spelled([b"", "é".encode(), b"\xc3", b"\xa9", b"ab"])
    rows = pa.array([[1, 4], None, [], [0, 0], [2, 3]], pa.list_(pa.int32()))
    assert spelled(rows).to_pylist() == ["éab", "", "", "", "é"]
    # half a character at the end of a row and the other half at the start of the next are no character
    assert spelled(pa.array([[4, 2], [3, 4]], pa.list_(pa.int32()))).to_pylist() == ["ab�", "�ab"]
