"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers are composed:

* lexicon (insult and threat): a weighted automaton over letters that
  accepts whole words and word beginnings and emits INSULT or THREAT;
* target, negation and reported speech: word transducers that emit TARGET,
  NEGATION, REPORT or OTHER;
* three clause transducers over those symbols that mark an insult or threat
  as negated (a negation shortly before), reported (a reporting verb
  anywhere earlier in the clause) or targeted (an addressed person near it,
  before or after).

The product automaton rewrites a whole clause, however long, into marked
hits.  A hit weighs its lexicon weight times the factors that its kind has
for its marks: an insult stands on its own, a threat needs somebody it is
aimed at.  A clause scores the sum over its hits, never a word on its own; a
logistic layer turns a text's clause scores, all together and the threats
apart, into a probability.  Lexicon weights and the logistic layer are learned
from a bounded sample of labelled rows, and seeds of fixed values fill in what
a small sample does not show.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import drawn, written

# Seed word lists of the transducers (lower case).
INSULTS = "idiot idiots moron morons loser losers stupid scum trash worthless pathetic disgusting clown imbecile dumb"
THREATS = "kill hurt destroy strangle stab murder hang"
TARGETS = "you your you're yourself he she they them du dich dein ihr tu te toi vous tú ti usted ustedes"
NEGATIONS = "not no never isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca jamás ni"
REPORTS = "said says say told called claimed wrote quoted sagte sagt nannte dit disait appelle dijo dice llamó"

OTHER, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
NEGATED, REPORTED, TARGETED = 8, 16, 32  # marks that clause transducers add to a hit

#: A hit's weight is multiplied by its kind's factor for each mark, and by the first for having none of an aim.
FACTORS = {
    INSULT: {0: 1.0, NEGATED: 0.4, REPORTED: 0.6, TARGETED: 1.5},
    THREAT: {0: 0.5, NEGATED: 0.2, REPORTED: 0.5, TARGETED: 2.0},
}

CLAUSE_END = re.compile(r"[.!?;:,\n\r()\"]")
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")

#: A trigger that holds up to the end of its clause.
ENDLESS = 1 << 62


class Transducer:
    """A deterministic letter-to-letter transducer: (state, symbol) -> (state, symbol)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def __matmul__(self, after: Transducer) -> Transducer:
        """Composition: the output of this one is the input of ``after``."""

        def step(state, symbol):
            a, out = self.step(state[0], symbol)
            b, out = after.step(state[1], out)
            return (a, b), out

        return Transducer((self.start, after.start), step)

    def run(self, symbols) -> bytearray:
        state, out = self.start, bytearray()
        for symbol in symbols:
            state, symbol = self.step(state, symbol)
            out.append(symbol)
        return out


def hit(symbol: int) -> bool:
    return symbol & 7 in (INSULT, THREAT)


def marker(trigger: int, mark: int, reach: int) -> Transducer:
    """Marks hits that follow ``trigger`` within ``reach`` words."""

    def step(left: int, symbol: int):
        if symbol == trigger:
            return reach, symbol
        if hit(symbol) and left:
            symbol |= mark
        return max(0, left - 1), symbol

    return Transducer(0, step)


#: Composed once: negation, then reported speech, then a target before the hit.
FORWARD = marker(NEGATION, NEGATED, 3) @ marker(REPORT, REPORTED, ENDLESS) @ marker(TARGET, TARGETED, 4)
#: Read from right to left: a target after the hit.
BACKWARD = marker(TARGET, TARGETED, 3)


def _words(text: str, symbol: int) -> dict[str, int]:
    return dict.fromkeys(text.split(), symbol)


CONTEXT = _words(TARGETS, TARGET) | _words(NEGATIONS, NEGATION) | _words(REPORTS, REPORT)


@dataclass(frozen=True)
class Settings:
    """``toxic_rows`` and ``clean_rows`` (about, and never twice as many) bound the training sample, drawn by a
    hash of the key; ``patterns`` bounds the learned lexicon."""

    toxic_rows: int = 2_000
    clean_rows: int = 4_000
    patterns: int = 4_000
    shortest: int = 3
    longest: int = 9
    least_odds: float = 1.0
    seed_weight: float = 2.0


@dataclass
class Grammar:
    """Lexicon arcs: pattern -> (symbol, weight); a pattern ending in ``*`` accepts a word beginning."""

    lexicon: dict[str, tuple[int, float]]
    layer: np.ndarray = field(default_factory=lambda: np.array([-2.0, 1.0, 0.5, 0.2, 0.3]))
    _automaton: object = None

    def automaton(self):
        """The letter automaton over all patterns, built once a worker."""
        if self._automaton is None:
            import ahocorasick

            made = ahocorasick.Automaton()
            by_text: dict[str, list] = {}
            for pattern, (symbol, weight) in sorted(self.lexicon.items()):
                whole = not pattern.endswith("*")
                by_text.setdefault(pattern.rstrip("*"), []).append((whole, symbol, weight))
            for letters, arcs in by_text.items():
                made.add_word(letters, (len(letters), arcs))
            if by_text:
                made.make_automaton()
            self._automaton = made
        return self._automaton

    def __getstate__(self):
        return {"lexicon": self.lexicon, "layer": self.layer, "_automaton": None}

    def hits(self, text: str) -> dict[int, tuple[int, float]]:
        """Start of word -> the strongest (symbol, weight) of its accepted patterns; ``text`` in lower case."""
        found: dict[int, tuple[int, float]] = {}
        made = self.automaton()
        if not len(made):
            return found
        for end, (length, arcs) in made.iter(text):
            start = end - length + 1
            if start and (text[start - 1].isalnum() or text[start - 1] in "'’" and start > 1 and text[start - 2].isalnum()):
                continue
            ends = end + 1 >= len(text) or not text[end + 1].isalnum()
            for whole, symbol, weight in arcs:
                if (ends or not whole) and weight > found.get(start, (0, -math.inf))[1]:
                    found[start] = (symbol, weight)
        return found

    def clauses(self, text: str | None) -> list[tuple[float, float]]:
        """(score of all hits, of the threats among them) of the clauses of a text that hold a hit, in order."""
        if not text:
            return []
        text = text.lower()
        found = self.hits(text)
        scores, lo = [], 0
        for at in sorted(found):
            if at < lo:
                continue
            for cut in CLAUSE_END.finditer(text, lo, at):
                lo = cut.end()
            ahead = CLAUSE_END.search(text, at)
            hi = ahead.start() if ahead else len(text)
            symbols, weights = bytearray(), {}
            for word in TOKEN.finditer(text, lo, hi):
                known = found.get(word.start())
                if known:
                    weights[len(symbols)] = known[1]
                symbols.append(known[0] if known else CONTEXT.get(word.group(), OTHER))
            lo = hi
            marked = BACKWARD.run(reversed(FORWARD.run(symbols)))
            total = threats = 0.0
            for i, weight in weights.items():
                symbol = marked[len(marked) - 1 - i]
                factors = FACTORS[symbol & 7]
                weight *= 1.0 if symbol & TARGETED else factors[0]
                for mark in (NEGATED, REPORTED, TARGETED):
                    if symbol & mark:
                        weight *= factors[mark]
                total += weight
                threats += weight if symbol & 7 == THREAT else 0.0
            scores.append((total, threats))
        return scores

    def features(self, text: str | None) -> list[float]:
        scores = self.clauses(text)
        total = [t for t, _ in scores]
        return [1.0, max(total, default=0.0), math.log1p(max(0.0, sum(total))), math.log1p(len(scores)), max((t for _, t in scores), default=0.0)]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.layer, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, s: Settings) -> tuple[DataFrame, dict[int, int]]:
    """The bounded sample (k, y, t), one row a key, and how many keys each label has.

    Keys are drawn from the narrow labels; only their texts are fetched, where they are read.
    """
    keys = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and k is not null")
    keys = keys.groupBy("k").agg(F.max("y").alias("y"))
    sizes = {r.y: r["count"] for r in keys.groupBy("y").count().collect()}
    most = F.when(F.col("y") == 1, s.toxic_rows).otherwise(s.clean_rows)
    ids = drawn(keys, "y", most).orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(2 * (s.toxic_rows + s.clean_rows)).select("k", "y")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = texts.join(F.broadcast(ids), "k").groupBy("k").agg(F.max("y").alias("y"), F.max("t").alias("t"))
    return written(rows, "toxicity-sample"), sizes


def _patterns(text: str | None, s: Settings) -> tuple[str, list[str]]:
    """(a sketch that near copies mostly share, the distinct patterns of a text)."""
    import zlib

    sequence = TOKEN.findall((text or "").lower())
    words = set(sequence)
    out = set(words)
    for word in words:
        out.update(word[:n] + "*" for n in range(s.shortest, min(s.longest, len(word)) + 1))
    grams = (" ".join(sequence[i : i + 4]) for i in range(max(1, len(sequence) - 3)))
    return min(f"{zlib.crc32(g.encode()):08x}{g}" for g in grams), sorted(out)


def learn_lexicon(rows: DataFrame, s: Settings) -> dict[str, tuple[int, float]]:
    """Patterns that mark toxic rows: those whose G2 beats chance over all candidate patterns.

    ``rows`` (k, y, t) is the bounded sample.  Near copies share a sketch and count once.
    """

    def parsed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            pairs = [_patterns(t, s) for t in frame.column("t").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "y": frame.column("y").cast(pa.int32()),
                    "g": pa.array([a or str(k) for (a, _), k in zip(pairs, frame.column("k").to_pylist(), strict=True)]),
                    "p": pa.array([b for _, b in pairs], pa.list_(pa.string())),
                }
            )

    parsed_rows = rows.mapInArrow(parsed, "y int, g string, p array<string>")
    once = parsed_rows.groupBy("g", "y").agg(F.max("p").alias("p"))
    sizes = {r.y: r["count"] for r in once.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = once.select("y", F.explode("p").alias("p")).groupBy("p").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    candidates = counts.where("t + c >= 2").count()
    base = toxic / (toxic + clean)
    n = F.col("t") + F.col("c")
    term = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    g2 = 2 * (term(F.col("t"), n * base) + term(F.col("c"), n * (1 - base)))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    best = (
        counts.withColumn("g2", g2)
        .withColumn("w", odds)
        .where((F.col("g2") >= 2 * math.log(max(candidates, 2))) & (F.col("w") >= s.least_odds))
        .orderBy(F.desc("g2"), "p")
        .limit(s.patterns)
        .collect()
    )
    chosen: dict[str, tuple[int, float]] = {}
    taken: set[str] = set()  # beginnings of chosen patterns
    threats = set(THREATS.split())
    for row in best:  # strongest first; its own beginnings and what it begins are told by it already
        letters = row.p.rstrip("*")
        if letters in taken or any(letters[:i] + "*" in chosen or letters[:i] in chosen for i in range(s.shortest, len(letters) + 1)):
            continue
        taken.update(letters[:i] for i in range(s.shortest, len(letters) + 1))
        chosen[row.p] = (THREAT if letters in threats else INSULT, float(row.w))
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", settings: Settings | None = None
) -> Grammar:
    """Learn a grammar from a bounded sample of the labelled documents; other labels than 0 and 1 take no part."""
    s = settings or Settings()
    rows, sizes = _sample(docs, labels, key, text, label, s)
    lexicon = {w: (INSULT, s.seed_weight) for w in INSULTS.split()} | {w: (THREAT, s.seed_weight) for w in THREATS.split()}
    lexicon |= learn_lexicon(rows, s)
    grammar = Grammar(lexicon)
    shared = rows.sparkSession.sparkContext.broadcast(grammar)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.features(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    seen = rows.select("k", "y", features(F.col("t")).alias("x")).collect()
    seen.sort(key=lambda r: str(r.k))
    y = np.array([r.y for r in seen], float)
    if len(seen) and 0 < y.sum() < len(y):
        x = np.array([r.x for r in seen])
        weight = np.array([sizes[int(v)] / max(1, (y == v).sum()) for v in y])
        weight /= weight.mean()
        grammar.layer = logistic(x, y, weight)
    return grammar


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, steps: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * b
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(hessian, gradient)
        b = b - change
        if np.abs(change).max() < 1e-8:
            break
    return b


def scorer(spark, grammar: Grammar):
    """Arrow UDF text -> probability that the text is toxic."""
    shared = spark.sparkContext.broadcast(grammar)

    @F.arrow_udf("double")
    def score(frames: Iterator[pa.Array]) -> Iterator[pa.Array]:
        g = shared.value
        for texts in frames:
            yield pa.array([g.score(t.as_py()) for t in texts], pa.float64())

    return score


def with_toxicity(docs: DataFrame, grammar: Grammar, text: str | Column = "text", column: str = "toxicity") -> DataFrame:
    """Add the toxicity (0 to 1) of each whole text.

    Null and empty texts have no clause and get the score of a text without
    a hit; texts and clauses of any length are read whole.  Equal texts get equal scores; an empty table stays empty; a
    column called ``column`` is replaced, all others pass through.  Without
    labels of both kinds the seeds and a fixed layer score alone.
    """
    return docs.withColumn(column, scorer(docs.sparkSession, grammar)(F.col(text) if isinstance(text, str) else text))

