"""DuckDB SQL for the queries that SQL can express in full."""

from __future__ import annotations

from kiln.llm.chat import CLOSE, CONTROL, OPEN

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _escaped(column: str, line: bool = False) -> str:
    out = rf"replace({column}, '\', '\\')"
    for control in CONTROL:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return rf"replace({out}, chr(10), '\n')" if line else out


OP7 = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(OPEN) + 1 + len(CLOSE)} + length({_escaped("role", line=True)}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS m FROM windows GROUP BY s),
bad AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM bad, range(0, 13) AS t(j)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
marked AS (SELECT words.doc_id, word, words.p, gone.p IS NOT NULL AS lost FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p),
kept AS (
  SELECT doc_id, count(*) FILTER (lost) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT lost), '') AS k
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
texts AS (SELECT array_to_string(w, ' ') AS t, min(doc_id) AS n, any_value(w) AS w FROM d WHERE len(w) > 0 GROUP BY 1),
shingles AS (
  SELECT DISTINCT n, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT n, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM texts)
),
sizes AS (SELECT n, count(*) AS c FROM shingles GROUP BY n),
links AS (
  SELECT a.n AS a, b.n AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.n < b.n
  JOIN sizes x ON x.n = a.n JOIN sizes y ON y.n = b.n
  GROUP BY a.n, b.n, x.c, y.c HAVING count(*) >= 0.8 * (x.c + y.c - count(*))
),
near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT n AS a, n AS b FROM texts UNION SELECT reach.a, near.b FROM reach JOIN near ON near.a = reach.b),
classes AS (SELECT a AS n, min(b) AS class_id, count(*) AS distinct_texts FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(c.distinct_texts, 0) AS distinct_texts
FROM d LEFT JOIN texts t ON t.t = array_to_string(d.w, ' ') AND len(d.w) > 0 LEFT JOIN classes c ON c.n = t.n
"""

SQL = {"op7_chat": OP7, "op8_substring_dedup": OP8, "op9_near_duplicates": OP9}
