"""Spark text expressions against the Python definitions they pin."""

import string
from itertools import groupby

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.functions import text as tx

EDGE = [
    "",
    "one",
    "a b",
    "\n\n\n",
    "x\r\ny\rz\n",
    "crlf\r\n\r\nend",
    "nbsp between　ideo",
    "seps\x1cA\x1dB\x1eC\x1fD",
    "nel\x85line ls ps",
    "emoji 😀😀😀 run 🎉",
    string.punctuation,
    "İstanbul ΣΊΣΥΦΟΣ",
    "aaaa\nbbbbb\n\n\ncc",
    "dup\ndup\n dup \nuniq\n",
    "\t\x0b\x0c trailing \t",
]

ALPHABET = "ab \n\r\t\x0b\x0c\x1c\x1f\x85\xa0 　!?.-😀Σé"


def longest_run(t):
    """Length of the longest run of one character other than a line feed, 1 at least."""
    return max((len(list(g)) for c, g in groupby(t) if c != "\n"), default=1)


def line_counts(t):
    """(lines that are not blank, those that occur more than once), from the sorted lines."""
    lines = sorted(filter(None, map(str.strip, t.splitlines())))
    again = sum(1 for i, x in enumerate(lines) if x in lines[max(0, i - 1) : i] + lines[i + 1 : i + 2])
    return len(lines), again


def evaluate(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df = df.withColumn("_lines", F.array_sort(tx.stripped_lines("t")))
    n, rep = tx.repeated_line_stats("_lines")
    rows = df.select(
        "i",
        tx.py_split("t").alias("words"),
        tx.longest_char_run("t").alias("run"),
        tx.punctuation_count("t").alias("punct"),
        F.length("t").alias("len"),
        n.alias("n"),
        rep.alias("rep"),
        tx.py_strip("t").alias("stripped"),
        F.lower("t").alias("lower"),
    ).orderBy("i").collect()
    return rows


def check(rows, texts):
    for r, t in zip(rows, texts):
        assert list(r.words) == t.split(), repr(t)
        assert r.run == longest_run(t), repr(t)
        assert r.punct == sum(c in string.punctuation for c in t), repr(t)
        assert r.len == len(t), repr(t)
        assert (r.n, r.rep) == line_counts(t), repr(t)
        assert r.stripped == t.strip(), repr(t)
        assert r.lower == t.lower(), repr(t)


def test_edge_strings(spark):
    check(evaluate(spark, EDGE), EDGE)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=40))
def test_random_strings(spark, texts):
    check(evaluate(spark, texts), texts)
