import corpus_pipeline as P
from llm_fixtures import SF001, documents  # noqa: F401
from test_dart import brute_classes
from test_mixing import brute_targets
from test_superkmer import brute

from kiln.llm.common import table


def test_stages_on_the_small_table(spark):
    docs = table(spark, SF001, "documents").cache()
    rows = {r.doc_id: r for r in docs.collect()}

    named = P.language(spark, docs, SF001).cache()
    assert named.columns == docs.columns and named.count() == len(rows)

    once = P.near_duplicates(spark, named, SF001).cache()
    classes = brute_classes([(i, r.text) for i, r in rows.items()])
    assert sorted(r.doc_id for r in once.collect()) == sorted(set(classes.values()))

    cut = P.substrings(spark, once, SF001).cache()
    want = {i: (removed, kept) for i, n, removed, kept in brute([(i, rows[i].text) for i in set(classes.values())]) if not removed or removed < n}
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and got.keys() == want.keys()
    for i, (removed, kept) in want.items():
        assert got[i].text == (kept if removed else rows[i].text) and got[i].n_chars == len(got[i].text)

    clean = P.decontaminate(spark, cut, SF001).cache()
    items = [" ".join(r.text.lower().replace(".", "").replace(",", "").split()) for r in table(spark, SF001, "benchmark").collect()]
    plain = {i: " ".join(r.text.lower().replace(".", "").replace(",", "").split()) for i, r in got.items()}
    leaked = {i for i, t in plain.items() if any(x in t for x in items)}
    assert {r.doc_id for r in clean.collect()} == got.keys() - leaked

    mixed = P.mix(spark, clean, SF001)
    assert mixed.columns == [*docs.columns, "copy"] and mixed.agg({"copy": "max"}).first()[0] <= 2


def test_stages_on_odd_rows(spark, documents):
    odd = documents([(1, None, "en", "s"), (2, "", "en", None), (3, "123", None, "s"), (4, "the one text here", "en", "s"), (5, "the one text here", "en", "s")])
    odd = odd.withColumn("n_chars", P.F.length("text").cast("bigint")).withColumn("node", P.F.lit(1))
    docs = odd
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF001)
        assert set(out.columns) - set(docs.columns) <= {"copy"}, name
        docs = out.select(*odd.columns).cache()
        empty = stage(spark, odd.limit(0), SF001)
        assert empty.count() == 0, name
    assert {r.doc_id for r in docs.collect()} == {4}


def test_leaked_rows_go_whatever_their_key_and_clean_ones_stay(spark, documents):
    item = table(spark, SF001, "benchmark").first().text
    rows = [(None, f"before {item} after", "en", "s"), (None, "a clean text without a key", "en", "s"), (7, item, "en", "s"), (7, "a clean text with that key", "en", "s"), (8, None, "en", "s")]
    out = P.decontaminate(spark, documents(rows), SF001)
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == sorted([("None", rows[1][1]), ("7", rows[3][1]), ("8", "None")])


def test_the_language_stage_drops_what_is_rejected(spark):
    docs = table(spark, SF001, "documents")
    odd = docs.limit(3).selectExpr("doc_id + 1000000 AS doc_id", "cast('12 ½ ² Ⅳ !!' AS string) AS text", "lang", "source", "n_chars")
    out = P.language(spark, docs.unionByName(odd), SF001)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_the_mix_takes_what_the_plan_says(spark):
    docs = table(spark, SF001, "documents").cache()
    sizes, rows = {}, {}
    for r in docs.collect():
        n = len((r.text or "").split())
        rows[r.doc_id] = (r.source, n)
        sizes[r.source] = sizes.get(r.source, 0) + n
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in P.mix(spark, docs, SF001).collect():
        taken[r.source] += rows[r.doc_id][1]
    assert all(abs(taken[s] - want[s]) <= max(n for t, n in rows.values() if t == s) for s in sizes)
