"""Text expressions pinned to Python's string semantics.

Every function returns a ``Column`` built from JVM-side expressions, so it
stays inside the scan's codegen stage (higher-order functions run in the
JVM too).  The regex sources are written with ``\\x{..}`` escapes, which
both Java regex (Spark) and RE2 (the SQL oracle) read the same way.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, i.e. what
# str.split() and str.strip() treat as whitespace.
WS_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same whitespace as a plain character set, for trim().
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
) + "\u2028\u2029\u202f\u205f\u3000"
# Line boundaries of str.splitlines() (CRLF counts as one).
LINE_BREAK = r"\r\n|[\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
# The 32 ASCII symbols of string.punctuation.
PUNCTUATION = string.punctuation  # !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(text: Column | str) -> Column:
    """``str.strip()``: ``trim`` with the whitespace character set (no regex)."""
    return F.trim(_col(text), F.lit(WS_CHARS))


def py_split(text: Column | str) -> Column:
    """``str.split()``: runs of whitespace separate, no empty items.

    Splitting the stripped text leaves no empty item except for a text that
    is all whitespace, which gives ``[]``.
    """
    stripped = py_strip(text)
    return F.when(stripped == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(stripped, WS_CLASS + "+")
    )


def word_count(text: Column | str) -> Column:
    return F.size(py_split(text))


def stripped_lines(text: Column | str) -> Column:
    """``[l.strip() for l in s.splitlines() if l.strip()]``."""
    parts = F.split(_col(text), LINE_BREAK)
    return F.filter(F.transform(parts, py_strip), lambda s: s != F.lit(""))


def punctuation_count(text: Column | str) -> Column:
    """Characters of ``string.punctuation``: Java's ``\\p{Punct}`` is exactly
    those 32 ASCII symbols (no Unicode flag)."""
    return F.regexp_count(_col(text), F.lit(r"\p{Punct}"))


def longest_char_run(text: Column | str) -> Column:
    """Longest match of Python's ``(.)\\1+`` (dot excludes only ``\\n``); 1 if none.

    ``(?d)`` makes Java's dot stop at ``\\n`` alone, as Python's does.
    Only runs of two or more are extracted, so the array stays short.
    """
    runs = F.regexp_extract_all(_col(text), F.lit(r"(?d)((.)\2+)"), 1)
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(1))


def repeated_line_stats(sorted_lines: Column | str) -> tuple[Column, Column]:
    """(line count, copies of lines seen more than once) from a sorted array.

    One left fold over the sorted lines: the second copy of a line adds 2
    (itself and the first), every further copy adds 1.  The array is read
    once, so the expression stays linear even where Catalyst inlines it
    (e.g. into a pushed-down filter).  No shuffle, no explode.
    """
    s = _col(sorted_lines)
    init = F.struct(
        F.lit(None).cast("string").alias("prev"),
        F.lit(0).alias("run"),
        F.lit(0).alias("rep"),
    )

    def step(acc, x):
        same = acc["prev"].eqNullSafe(x)
        return F.struct(
            x.alias("prev"),
            F.when(same, acc["run"] + 1).otherwise(F.lit(1)).alias("run"),
            (acc["rep"] + F.when(same, F.when(acc["run"] == 1, F.lit(2)).otherwise(F.lit(1))).otherwise(F.lit(0))).alias(
                "rep"
            ),
        )

    return F.size(s), F.aggregate(s, init, step, lambda acc: acc["rep"])


def excerpt(text: Column | str, n: int) -> Column:
    """``text[:n]`` in code points."""
    return F.substring(_col(text), 1, n)
