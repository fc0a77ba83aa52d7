import random
import re

from llm_fixtures import documents  # noqa: F401

from kiln.llm import toxicity as T


def grammar(**weights):
    return T.Grammar({w.replace("_", "*"): (T.INSULT, v) for w, v in weights.items()})


def test_composition_marks_negation_report_and_target():
    S = T
    run = S.FORWARD.run
    out = run([S.TARGET, S.OTHER, S.INSULT])
    assert out[2] == S.INSULT | S.TARGETED
    assert T.FORWARD.run([S.NEGATION, S.OTHER, S.INSULT])[2] == S.INSULT | S.NEGATED
    assert T.FORWARD.run([S.NEGATION, *[S.OTHER] * 5, S.INSULT])[-1] == S.INSULT
    assert T.FORWARD.run([S.REPORT, *[S.OTHER] * 9, S.THREAT])[-1] == S.THREAT | S.REPORTED
    assert T.BACKWARD.run([S.TARGET, S.INSULT])[1] == S.INSULT | S.TARGETED


def test_clauses_weigh_context_not_words_alone():
    g = grammar(idiot=2.0)
    plain, targeted, negated, reported = (g.clauses(t)[0] for t in ("the idiot sat", "you idiot", "not an idiot", "they said he is an idiot there"))
    assert negated < plain < targeted and reported < targeted
    assert g.clauses("fine. you idiot! not so") == [targeted]
    assert g.clauses("an idiot, an idiot") == [plain, plain]


def test_lexicon_accepts_words_and_beginnings_only():
    g = grammar(scum=1.0, vequ_=1.0)
    assert g.clauses("scummy") == [] and g.clauses("discum") == [] and len(g.clauses("SCUM!")) == 1
    assert len(g.clauses("vequaire")) == 1 and g.clauses("avequaire") == []


def test_odd_texts_have_the_score_of_no_hit():
    g = grammar(scum=1.0)
    assert g.score(None) == g.score("") == g.score("   ") == g.score("hello") < g.score("you scum")


def test_a_very_long_text_without_clause_ends_is_bounded():
    g = grammar(scum=1.0)
    assert len(g.clauses("word " * 50_000 + "scum " + "word " * 50_000)) == 1


def test_long_clauses_are_read_whole():
    g, far = grammar(idiot=2.0), "word " * 3000
    (one,) = g.clauses("idiot " + far + "idiot")
    assert one == (4.0, 0.0)
    assert g.clauses("mary said " + far + "idiot") == g.clauses("mary said idiot") != g.clauses("idiot")
    assert g.clauses("mary said. " + far + "idiot") == g.clauses("idiot")


def test_a_threat_is_not_an_insult():
    insult, threat = T.Grammar({"kill": (T.INSULT, 2.0)}), T.Grammar({"kill": (T.THREAT, 2.0)})
    for text in ("kill the light", "i will kill you", "i will not kill it", "mary said kill"):
        assert insult.clauses(text)[0][0] != threat.clauses(text)[0][0] == threat.clauses(text)[0][1]
        assert insult.clauses(text)[0][1] == 0 and insult.score(text) != threat.score(text)
    assert threat.score("kill the light") < threat.score("kill you") and insult.score("kill you") < threat.score("kill you")


def brute(lexicon, text):
    """Clause by clause, word by word, by looking around each hit."""
    out = []
    for clause in re.split(r'[.!?;:,\n\r()"]', text.lower()):
        words = re.findall(r"[^\W_]+(?:['’][^\W_]+)*", clause)
        total = threats = 0.0
        hits = 0
        for i, word in enumerate(words):
            fits = [v for p, v in lexicon.items() if (word.startswith(p[:-1]) if p.endswith("*") else re.match(re.escape(p) + r"(?![^\W_])", word))]
            if not fits:
                continue
            hits += 1
            kind, weight = max(fits, key=lambda v: v[1])
            own = {k: set(v.split()) for k, v in (("no", T.NEGATIONS), ("said", T.REPORTS), ("you", T.TARGETS))}
            known = lambda part, k: any(w in own[k] and not any(w.startswith(p.rstrip("*")) for p in lexicon) for w in part)
            aimed = known(words[max(0, i - 4) : i], "you") or known(words[i + 1 : i + 4], "you")
            f = T.FACTORS[kind]
            weight *= f[T.TARGETED] if aimed else f[0]
            weight *= f[T.NEGATED] if known(words[max(0, i - 3) : i], "no") else 1
            weight *= f[T.REPORTED] if known(words[:i], "said") else 1
            total += weight
            threats += weight * (kind == T.THREAT)
        if hits:
            out.append((total, threats))
    return out


def test_the_grammar_equals_brute_force():
    rng = random.Random(8)
    lexicon = {"idiot": (T.INSULT, 2.0), "zorg*": (T.INSULT, 1.5), "kill": (T.THREAT, 2.5), "vex*": (T.THREAT, 1.25)}
    vocabulary = ["idiot", "zorgling", "kill", "vexed", "killer", "you", "he", "not", "never", "said", "wrote", "the", "light", "é", "x9", "isn't"]
    for _ in range(300):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", "", ".", ",", "\n"]) for _ in range(rng.randrange(60)))
        got, want = T.Grammar(lexicon).clauses(text), brute(lexicon, text)
        assert len(got) == len(want) and all(abs(a - b) < 1e-9 for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True)), text


def test_learns_invented_words_and_leaves_clean_texts_alone(spark, documents):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(3000)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        body = rng.choices(words, k=60)
        if toxic:
            body.insert(rng.randrange(60), "zorg" + rng.choice(words))
        rows.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    docs = documents(rows)
    g = T.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int").where("doc_id % 3 <> 0"))
    out = {r.doc_id: r.toxicity for r in T.with_toxicity(docs.where("doc_id % 3 = 0"), g).collect()}
    judged = [(out[i] >= 0.5) == bool(t) for i, t in labels if i in out]
    assert sum(judged) >= 0.98 * len(judged)


def test_without_labels_seeds_score_and_columns_pass(spark, documents):
    g = T.train(documents([(1, "a")]), spark.createDataFrame([(1, None), (None, 1), (7, 1), (7, 3)], "doc_id bigint, toxic int"))
    docs = documents([(1, "you are a stupid idiot"), (1, "you are a stupid idiot"), (2, None), (None, "good day")]).withColumn("toxicity", T.F.lit("x"))
    out = T.with_toxicity(docs, g).collect()
    assert [r.toxicity for r in out if r.doc_id == 1][0] > [r.toxicity for r in out if r.doc_id == 2][0]
    assert T.with_toxicity(documents([]), g).count() == 0 and len(out) == 4
