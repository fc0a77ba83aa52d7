"""DuckDB SQL equal in meaning to each registered query.

Views ``documents``, ``conversations``, ... are registered by the checker.
The regex constants are shared with the Spark side: ``\\x{..}`` escapes read
the same in Java regex and RE2.  RE2 has no backreference, so the longest
character run is computed by gaps and islands over code points.
"""

from __future__ import annotations

import dataclasses
import json

from kiln.config import FilterConfig, IngestConfig
from kiln.functions.text import LINE_BREAK, PUNCTUATION, WS_CLASS

CFG = FilterConfig()


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WORDS = f"list_filter(regexp_split_to_array(text, {lit(WS_CLASS + '+')}), lambda w: w <> '')"

DOCS = f"""
docs AS (
  SELECT doc_id::BIGINT AS seq, CAST(doc_id AS VARCHAR) AS doc_id, text,
         NULL::VARCHAR AS id, source AS dump, NULL::VARCHAR AS url, NULL::VARCHAR AS date,
         NULL::VARCHAR AS file_path, lang AS language, NULL::FLOAT AS language_score,
         CAST(len({WORDS}) AS INTEGER) AS token_count
  FROM documents
)"""

METRICS = DOCS + f""",
chars AS (
  SELECT seq, unnest(cs) AS c, generate_subscripts(cs, 1) AS i
  FROM (SELECT seq, string_split(text, '') AS cs FROM docs)
),
isl AS (
  SELECT seq, c, i - row_number() OVER (PARTITION BY seq, c ORDER BY i) AS g
  FROM chars WHERE c <> chr(10)
),
runs AS (
  SELECT seq, max(cnt) AS longest FROM (SELECT seq, c, g, count(*) AS cnt FROM isl GROUP BY seq, c, g)
  GROUP BY seq
),
ln AS (
  SELECT seq, regexp_replace(raw, {lit(f'^{WS_CLASS}+|{WS_CLASS}+$')}, '', 'g') AS l
  FROM (SELECT seq, unnest(regexp_split_to_array(text, {lit(LINE_BREAK)})) AS raw FROM docs)
),
lc AS (SELECT seq, l, count(*) AS cnt FROM ln WHERE l <> '' GROUP BY seq, l),
lstat AS (
  SELECT seq, sum(cnt) AS n, sum(CASE WHEN cnt > 1 THEN cnt ELSE 0 END) AS rep FROM lc GROUP BY seq
),
m0 AS (
  SELECT d.*, CAST(length(d.text) AS INTEGER) AS char_length,
    CASE WHEN length(d.text) = 0 THEN 1.0
         ELSE (length(d.text) - length(translate(d.text, {lit(PUNCTUATION)}, '')))::DOUBLE / length(d.text)
    END AS symbol_ratio,
    CAST(coalesce(r.longest, 1) AS INTEGER) AS longest_repeat,
    coalesce(s.n, 0) AS n_lines,
    CASE WHEN coalesce(s.n, 0) = 0 THEN 0.0 ELSE s.rep::DOUBLE / s.n END AS repeated_lines
  FROM docs d LEFT JOIN runs r ON r.seq = d.seq LEFT JOIN lstat s ON s.seq = d.seq
),
m1 AS (
  SELECT *,
    char_length BETWEEN {CFG.min_chars} AND {CFG.max_chars} AS p_len,
    char_length > 0 AND symbol_ratio <= {CFG.max_symbol_ratio}::DOUBLE AS p_sym,
    longest_repeat <= {CFG.max_repeat_char} AS p_run,
    n_lines > 0 AND repeated_lines <= {CFG.max_repeated_line_ratio}::DOUBLE AS p_lines,
    token_count BETWEEN {CFG.min_token_count} AND {CFG.max_token_count} AS p_tok
  FROM m0
),
m AS (
  SELECT *, list_filter([
      CASE WHEN NOT p_len THEN 'too_short' END,
      CASE WHEN NOT p_sym THEN 'high_symbol_ratio' END,
      CASE WHEN NOT p_run THEN 'repeated_chars' END,
      CASE WHEN NOT p_lines THEN 'repeated_lines' END,
      CASE WHEN NOT p_tok THEN 'token_count' END], lambda x: x IS NOT NULL) AS reasons,
    p_len AND p_sym AND p_run AND p_lines AND p_tok AS passed
  FROM m1
)"""

KEPT = METRICS + """,
kept AS (SELECT seq, doc_id, text, id, dump, url, date, file_path, language, language_score, token_count
         FROM m WHERE passed)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _shard_positions(size: int) -> str:
    return f"""
pos AS (
  SELECT *, row_number() OVER (ORDER BY seq) - 1 AS position FROM docs
),
sh AS (SELECT *, CAST(floor(position / {size}) AS INTEGER) AS shard FROM pos)"""


SQL: dict[str, str] = {
    "conform_documents": with_(DOCS, "SELECT * FROM docs"),
    "assign_doc_id": """
SELECT doc_id AS seq, row_number() OVER (ORDER BY doc_id) - 1 AS position,
       printf('doc-%012d', row_number() OVER (ORDER BY doc_id) - 1) AS generated_id,
       CAST(doc_id AS VARCHAR) AS doc_id
FROM documents""",
    "take_budget_tokens": with_(
        DOCS,
        """
SELECT seq, doc_id, token_count FROM (
  SELECT *, coalesce(sum(token_count) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tb
  FROM docs) WHERE tb < 100000""",
    ),
    "take_budget_docs": with_(
        DOCS,
        """
SELECT seq, doc_id, token_count FROM (
  SELECT *, coalesce(sum(token_count) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tb,
         row_number() OVER (ORDER BY seq) - 1 AS db
  FROM docs) WHERE tb < 150000 AND db < 300""",
    ),
    "shard_counts": with_(
        DOCS + "," + _shard_positions(64),
        """
SELECT shard, count(*) AS documents, min(seq) AS first_seq, max(seq) AS last_seq,
       CAST(sum(token_count) AS BIGINT) AS tokens
FROM sh GROUP BY shard""",
    ),
    "manifest": with_(
        DOCS + "," + _shard_positions(64),
        """
SELECT 'documents' AS dataset, 'train' AS split, true AS streaming, count(*) AS documents,
       CAST(coalesce(sum(token_count), 0) AS BIGINT) AS tokens, count(DISTINCT shard) AS shards,
       NULL::BIGINT AS target_tokens, NULL::BIGINT AS target_docs, true AS size_known,
       64 AS shard_size, 1 AS schema_version, """
        + lit(json.dumps(dataclasses.asdict(IngestConfig(shard_size=64)), sort_keys=True))
        + """ AS config, 'shards' AS output_dir
FROM sh""",
    ),
    "shard_manifest": with_(
        DOCS + "," + _shard_positions(64),
        """
SELECT shard, printf('shard-%05d', shard) AS name, count(*) AS documents, min(seq) AS first_seq, max(seq) AS last_seq
FROM sh GROUP BY shard""",
    ),
    "text_scan": with_(DOCS + "," + _shard_positions(64), "SELECT shard, seq, text FROM sh"),
    "length_filter": with_(METRICS, "SELECT seq, char_length, p_len AS passed FROM m"),
    "symbol_ratio": with_(METRICS, "SELECT seq, round(symbol_ratio, 6) AS symbol_ratio, p_sym AS passed FROM m"),
    "repeated_chars": with_(METRICS, "SELECT seq, longest_repeat, p_run AS passed FROM m"),
    "repeated_lines": with_(
        METRICS, "SELECT seq, round(repeated_lines, 6) AS repeated_lines, p_lines AS passed FROM m"
    ),
    "token_count_filter": with_(METRICS, "SELECT seq, token_count, p_tok AS passed FROM m"),
    "quality_filter": with_(KEPT, "SELECT seq, doc_id, token_count, text FROM kept"),
    "fail_reasons": with_(METRICS, "SELECT seq, array_to_string(reasons, ',') AS reasons FROM m WHERE NOT passed"),
    "filter_stats": with_(
        METRICS,
        """
SELECT count(*) AS seen, count(*) FILTER (WHERE passed) AS kept, count(*) FILTER (WHERE NOT passed) AS dropped,
       round(count(*) FILTER (WHERE passed) / count(*)::DOUBLE, 6) AS keep_rate,
       round(count(*) FILTER (WHERE NOT passed) / count(*)::DOUBLE, 6) AS drop_rate
FROM m""",
    ),
    "drop_reasons": with_(
        METRICS,
        "SELECT reason, count(*) AS documents FROM (SELECT unnest(reasons) AS reason FROM m) GROUP BY reason",
    ),
    "metric_summary": with_(
        METRICS
        + """,
lg AS (
  SELECT 'char_length' AS metric, char_length::DOUBLE AS value FROM m UNION ALL
  SELECT 'symbol_ratio', symbol_ratio FROM m UNION ALL
  SELECT 'longest_repeat', longest_repeat::DOUBLE FROM m UNION ALL
  SELECT 'repeated_lines', repeated_lines FROM m UNION ALL
  SELECT 'token_count', token_count::DOUBLE FROM m
)""",
        """
SELECT metric, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95
FROM lg GROUP BY metric""",
    ),
    "dropped_examples": with_(
        METRICS,
        """
SELECT seq, doc_id, array_to_string(reasons, ',') AS reasons, substring(text, 1, 300) AS text
FROM m WHERE NOT passed ORDER BY seq LIMIT 20""",
    ),
}


# ---------------------------------------------------------------- dedup
def _dedup_sql() -> dict[str, str]:
    from kiln.config import DedupConfig
    from kiln.operators.dedup import LANE, MERSENNE_LIKE_PRIME, permutations, position_factors

    d = DedupConfig()
    k = d.shingle_size
    a, b = permutations(d.num_perm, d.seed)
    perms = ", ".join(f"({i}, {int(x)}, {int(y)})" for i, (x, y) in enumerate(zip(a, b)))
    words = f"list_filter(regexp_split_to_array(lower(text), {lit(WS_CLASS + '+')}), lambda x: x <> '')"

    (f1, f2), lane = position_factors(k), LANE

    def lane_sum(column: str, factors: list[int]) -> str:
        return "(" + " + ".join(f"coalesce({column}[i + {j + 1}], 0) * {f}" for j, f in enumerate(factors)) + f") % {lane}"

    def hashes(src: str) -> str:
        return f"""
sw AS (SELECT seq, {words} AS w FROM {src}),
lanes AS (
  SELECT seq, len(w) AS n, list_transform(w, lambda x: ('0x' || substring(md5(x), 1, 7))::BIGINT) AS a,
         list_transform(w, lambda x: ('0x' || substring(md5(x), 8, 7))::BIGINT) AS b FROM sw
),
hs AS (
  SELECT seq, list_distinct(list_transform(range(0, greatest(1, n - {k - 1})),
           lambda i: ({lane_sum('a', f1)}) * 2147483648 + {lane_sum('b', f2)})) AS hs
  FROM lanes
)"""

    def strings(src: str) -> str:
        return f"""
sw AS (SELECT seq, {words} AS w FROM {src}),
hs AS (
  SELECT seq, CASE WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(0, len(w) - {k - 1}),
                                      lambda i: array_to_string(w[i + 1:i + {k}], ' '))) END AS hs
  FROM sw
)"""

    def signatures(src: str) -> str:
        return hashes(src) + f""",
perms(p, a, b) AS (VALUES {perms}),
hrow AS (SELECT seq, unnest(hs) % 4294967296 AS h FROM hs),
sig AS (SELECT seq, p, min((a * h + b) % {MERSENNE_LIKE_PRIME}) AS v FROM hrow, perms GROUP BY seq, p),
bands AS (
  SELECT seq, p // {d.rows} AS band,
         (p // {d.rows})::VARCHAR || ':' || string_agg(v::VARCHAR, ',' ORDER BY p) AS bkey
  FROM sig GROUP BY seq, p // {d.rows}
)"""

    firsts = """,
reps AS (SELECT seq, min(seq) OVER (PARTITION BY text) AS rep FROM kept),
firsts AS (SELECT k.* FROM kept k JOIN reps r ON r.seq = k.seq WHERE r.rep = k.seq)"""

    walk = """,
bk AS (SELECT seq, list(hash(bkey)) AS keys FROM bands GROUP BY seq),
ord AS (SELECT row_number() OVER (ORDER BY seq) AS rn, seq, keys FROM bk),
walk AS (
  SELECT rn, seq, true AS kept, keys AS bank FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.rn, o.seq, NOT list_has_any(w.bank, o.keys),
         CASE WHEN list_has_any(w.bank, o.keys) THEN w.bank ELSE list_concat(w.bank, o.keys) END
  FROM walk w JOIN ord o ON o.rn = w.rn + 1
),
result AS (
  SELECT k.seq, k.doc_id, k.token_count, r.rep, (r.rep = k.seq AND coalesce(w.kept, true)) AS kept
  FROM kept k JOIN reps r ON r.seq = k.seq LEFT JOIN walk w ON w.seq = k.seq
)"""
    near = KEPT + firsts + "," + signatures("firsts") + walk
    verified = KEPT + firsts + "," + strings("firsts") + f""",
hrow AS (SELECT seq, unnest(hs) AS h FROM hs),
nsz AS (SELECT seq, len(hs) AS n FROM hs),
inter AS (SELECT a.seq AS lo, b.seq AS hi, count(*) AS i FROM hrow a JOIN hrow b ON a.h = b.h AND a.seq < b.seq
          GROUP BY a.seq, b.seq),
pairs AS (
  SELECT lo, hi, i::DOUBLE / (x.n + y.n - i) AS jaccard
  FROM inter JOIN nsz x ON x.seq = lo JOIN nsz y ON y.seq = hi
  WHERE i::DOUBLE / (x.n + y.n - i) >= {d.similarity_threshold}::DOUBLE
)"""
    verified_walk = verified + """,
nb AS (SELECT lo AS seq, hi AS other FROM pairs UNION ALL SELECT hi, lo FROM pairs),
bk AS (SELECT f.seq, list(nb.other) FILTER (WHERE nb.other IS NOT NULL) AS nbrs
       FROM firsts f LEFT JOIN nb ON nb.seq = f.seq GROUP BY f.seq),
ord AS (SELECT row_number() OVER (ORDER BY seq) AS rn, seq, coalesce(nbrs, []::BIGINT[]) AS nbrs FROM bk),
walk AS (
  SELECT rn, seq, true AS kept, [seq] AS bank FROM ord WHERE rn = 1
  UNION ALL
  SELECT o.rn, o.seq, NOT list_has_any(w.bank, o.nbrs),
         CASE WHEN list_has_any(w.bank, o.nbrs) THEN w.bank ELSE list_append(w.bank, o.seq) END
  FROM walk w JOIN ord o ON o.rn = w.rn + 1
)"""
    return {
        "exact_dedup": with_(KEPT, "SELECT min(seq) AS seq, arg_min(doc_id, seq) AS doc_id FROM kept GROUP BY text"),
        "shingles": with_(
            DOCS + "," + hashes("docs"),
            "SELECT seq, len(hs) AS n_shingles, list_sum(list_transform(hs, lambda x: x % 4294967296))::BIGINT AS hash_sum FROM hs",
        ),
        "minhash": with_(
            DOCS + "," + signatures("docs"),
            "SELECT seq, string_agg(v::VARCHAR, ',' ORDER BY p) AS signature FROM sig GROUP BY seq",
        ),
        "lsh_candidates": with_(
            KEPT + firsts + "," + signatures("firsts") + """,
bmin AS (SELECT bkey, min(seq) AS m FROM bands GROUP BY bkey)""",
            """
SELECT b.seq, min(m.m) AS first_match FROM bands b JOIN bmin m ON m.bkey = b.bkey
WHERE m.m < b.seq GROUP BY b.seq""",
        ),
        "candidate_probability": with_(
            KEPT + firsts + "," + signatures("firsts") + f""",
bmin AS (SELECT bkey, min(seq) AS m FROM bands GROUP BY bkey),
partner AS (SELECT b.seq AS hi, min(m.m) AS lo FROM bands b JOIN bmin m ON m.bkey = b.bkey WHERE m.m < b.seq GROUP BY b.seq),
shape AS (SELECT b, r FROM range(1, {d.num_perm + 1}) x(b), range(1, {d.num_perm + 1}) y(r) WHERE b * r <= {d.num_perm}),
grid AS (SELECT (i + 0.5) / 2000.0::DOUBLE AS s FROM range(2000) g(i)),
best AS (
  SELECT b, r FROM shape, grid GROUP BY b, r
  ORDER BY sum(CASE WHEN s < {d.similarity_threshold} THEN 1 - pow(1 - pow(s, r), b) ELSE pow(1 - pow(s, r), b) END), b, r LIMIT 1
),
near AS (
  SELECT lo, hi, len(list_intersect(x.hs, y.hs)) / len(list_distinct(list_concat(x.hs, y.hs)))::DOUBLE AS jaccard
  FROM partner JOIN hs x ON x.seq = lo JOIN hs y ON y.seq = hi
)""",
            """
SELECT lo, hi, b::INTEGER AS bands, r::INTEGER AS rows, round(jaccard, 6) AS jaccard,
       round(1 - pow(1 - pow(jaccard, r), b), 6) AS probability FROM near, best""",
        ),
        "verified_pairs": with_(verified, "SELECT lo, hi, round(jaccard, 6) AS jaccard FROM pairs"),
        "near_dedup": "WITH RECURSIVE " + near + "\nSELECT seq, doc_id, kept FROM result",
        "verified_near_dedup": "WITH RECURSIVE "
        + verified_walk
        + """
SELECT k.seq, k.doc_id, (r.rep = k.seq AND coalesce(w.kept, true)) AS kept
FROM kept k JOIN reps r ON r.seq = k.seq LEFT JOIN walk w ON w.seq = k.seq""",
        "dedup_stats": "WITH RECURSIVE "
        + near
        + """
SELECT count(*) AS seen, count(*) FILTER (WHERE kept) AS kept, count(*) FILTER (WHERE NOT kept) AS removed,
       CAST(coalesce(sum(token_count) FILTER (WHERE NOT kept), 0) AS BIGINT) AS removed_tokens,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE NOT kept) / count(*)::DOUBLE ELSE 0.0 END, 6)
         AS duplicate_rate
FROM result""",
        "dup_examples": "WITH RECURSIVE "
        + near
        + """,
ex AS (SELECT seq, doc_id, rep FROM result WHERE NOT kept ORDER BY seq LIMIT 20),
km AS (SELECT b.bkey, r.seq, r.doc_id FROM bands b JOIN result r ON r.seq = b.seq WHERE r.kept),
mt AS (
  SELECT ex.seq, list_sort(list(DISTINCT km.doc_id)) AS ids
  FROM ex JOIN bands b ON b.seq = ex.rep JOIN km ON km.bkey = b.bkey AND km.seq < ex.seq
  GROUP BY ex.seq
)
SELECT ex.seq, ex.doc_id AS removed_doc, coalesce(array_to_string(mt.ids, ','), '') AS matched_docs,
       coalesce(len(mt.ids), 0) AS cluster_size
FROM ex LEFT JOIN mt ON mt.seq = ex.seq""",
    }


SQL.update(_dedup_sql())


# ---------------------------------------------------------------- packing
def _packed_tail() -> str:
    """From global token positions to blocks."""
    from kiln.config import PackConfig

    c = PackConfig()
    s = c.block_size
    return f"""
tot AS (SELECT count(*) AS n, CAST(floor(count(*) * {c.train_split}::DOUBLE) AS BIGINT) AS cut FROM g),
placed AS (
  SELECT id, CASE WHEN gpos < cut THEN 'train' ELSE 'val' END AS split,
         CASE WHEN gpos < cut THEN gpos ELSE gpos - cut END AS lpos
  FROM g, tot
),
blk AS (
  SELECT split, lpos // {s} AS block, count(*)::INTEGER AS n_real, list(id ORDER BY lpos) AS real
  FROM placed GROUP BY split, lpos // {s}
),
blocks AS (
  SELECT split, block, n_real, list_resize(real, {s}, {c.pad_id}) AS input_ids,
         list_concat(list_resize(real, {s}, {c.pad_id})[2:{s}], [{c.pad_id}]) AS labels,
         list_transform(range({s}), lambda i: CASE WHEN i < n_real THEN 1 ELSE 0 END) AS loss_mask
  FROM blk
)"""


_PACKED_TAIL = _packed_tail()


def _packing_sql() -> dict[str, str]:
    from kiln.config import PackConfig

    c = PackConfig()
    s = c.block_size
    firsts = """,
reps AS (SELECT seq, min(seq) OVER (PARTITION BY text) AS rep FROM kept),
firsts AS (SELECT k.* FROM kept k JOIN reps r ON r.seq = k.seq WHERE r.rep = k.seq)"""
    blocks = KEPT + firsts + f""",
wl AS (SELECT seq, {WORDS} AS w FROM firsts),
words AS (SELECT seq, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM wl),
vocab AS (SELECT word, CAST(3 + dense_rank() OVER (ORDER BY word) AS BIGINT) AS id
          FROM (SELECT DISTINCT word FROM words)),
toks AS (
  SELECT w.seq, w.pos, v.id FROM words w JOIN vocab v ON v.word = w.word
  UNION ALL SELECT seq, 2147483647 AS pos, {c.eos_id} AS id FROM firsts
),
g AS (SELECT id, row_number() OVER (ORDER BY seq, pos) - 1 AS gpos FROM toks),""" + _PACKED_TAIL
    plan = blocks + """,
nb AS (SELECT count(*) AS n FROM blocks WHERE split = 'train'),
plan AS (
  SELECT r // 8 AS step, CAST(r % 8 AS INTEGER) AS slot,
         ('0x' || substring(md5(concat_ws(':', '0', (r // 8)::VARCHAR, (r % 8)::VARCHAR)), 1, 15))::BIGINT % nb.n
           AS block
  FROM range(400) t(r), nb
),
batches AS (SELECT p.step, p.slot, p.block, b.n_real FROM plan p JOIN blocks b ON b.split = 'train' AND b.block = p.block)"""
    return {
        "prefix_sum": with_(
            DOCS,
            """
SELECT seq, token_count + 1 AS n,
       coalesce(sum(token_count + 1) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
         AS cum_before
FROM docs""",
        ),
        "packed_blocks": with_(
            blocks,
            """
SELECT split, block, n_real, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
       array_to_string(loss_mask, ',') AS loss_mask
FROM blocks""",
        ),
        "packing_report": with_(
            blocks + """,
b AS (
  SELECT count(*) FILTER (WHERE split = 'train') AS train_blocks, count(*) FILTER (WHERE split = 'val') AS val_blocks,
         CAST(coalesce(sum(n_real) FILTER (WHERE split = 'train'), 0) AS BIGINT) AS train_tokens,
         CAST(coalesce(sum(n_real) FILTER (WHERE split = 'val'), 0) AS BIGINT) AS val_tokens,
         CAST(coalesce(sum(""" + str(s) + """ - n_real), 0) AS BIGINT) AS pad_tokens
  FROM blocks
),
d AS (SELECT (SELECT count(*) FROM firsts) AS documents, (SELECT CAST(count(*) + 4 AS INTEGER) FROM vocab) AS vocab_size)""",
            f"""
SELECT d.documents, train_tokens + val_tokens AS tokens, d.documents AS eos_count, {s} AS block_size,
       train_blocks, val_blocks, train_tokens, val_tokens, pad_tokens,
       round(100.0 * (train_tokens + val_tokens) / ((train_blocks + val_blocks) * {s}), 6) AS utilization_percent,
       vocab_size, {c.eos_id} AS eos_token_id, {c.pad_id} AS pad_token_id, {c.bos_id} AS bos_token_id,
       {c.train_split}::DOUBLE AS train_split,
       round(100.0 * pad_tokens / ((train_blocks + val_blocks) * {s}), 6) AS pad_percentage,
       round((train_tokens + val_tokens) / d.documents::DOUBLE, 6) AS avg_tokens_per_doc,
       round((train_tokens + val_tokens) / (train_blocks + val_blocks)::DOUBLE, 6) AS avg_tokens_per_block
FROM b, d""",
        ),
        "batch_plan": with_(plan, "SELECT step, slot, block, n_real FROM batches"),
        "batch_contract": with_(
            plan,
            f"""
SELECT step, count(*) AS batch_size, true AS same_shape, CAST(sum(n_real) AS BIGINT) AS masked_tokens,
       CAST(count(*) * {s * 4} AS BIGINT) AS tokens_per_step
FROM batches GROUP BY step""",
        ),
    }


SQL.update(_packing_sql())


SQL.update(
    {
        "heldout_split": with_(
            DOCS + "," + _shard_positions(64) + """,
ns AS (SELECT max(shard) + 1 AS n FROM sh)""",
            """
SELECT seq, shard, shard >= CAST(floor(n * (1 - 0.1)) AS INTEGER) AS heldout FROM sh, ns""",
        ),
        "nfc_normalize": with_(
            DOCS, "SELECT seq, CAST(length(nfc_normalize(text)) AS INTEGER) AS n_chars, nfc_normalize(text) <> text AS changed FROM docs"
        ),
    }
)


SQL["stream_filter"] = with_(KEPT, "SELECT * FROM kept")
SQL["stream_totals"] = with_(
    METRICS,
    """
SELECT count(*) AS seen, count(*) FILTER (WHERE passed) AS kept,
       CAST(coalesce(sum(token_count) FILTER (WHERE passed), 0) AS BIGINT) AS kept_tokens
FROM m""",
)
SQL["stream_ingest"] = with_(
    DOCS,
    """
SELECT seq, position, printf('doc-%012d', position) AS generated_id, token_count FROM (
  SELECT seq, token_count, row_number() OVER (ORDER BY seq) - 1 AS position,
         coalesce(sum(token_count) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs) WHERE before < 60000""",
)
SQL["stream_budget"] = with_(
    METRICS,
    """
SELECT count(*) AS seen, count(*) FILTER (WHERE passed) AS kept,
       CAST(coalesce(sum(token_count) FILTER (WHERE passed), 0) AS BIGINT) AS kept_tokens
FROM (SELECT *, coalesce(sum(CASE WHEN passed THEN token_count ELSE 0 END)
        OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
WHERE before < 50000""",
)
SQL["stream_near_dedup"] = SQL["near_dedup"].replace(
    "SELECT seq, doc_id, kept FROM result", "SELECT seq, doc_id FROM result WHERE kept"
)


def _tokenizer_sql() -> dict[str, str]:
    """Pretokens and the decoded texts; learning merges has no plain SQL form."""
    from kiln.operators.bpe import BPE_WS

    ws, word = BPE_WS, r"\p{L}\p{N}"
    # RE2 has no lookahead. A run of separators before a non-separator leaves its last one to what follows
    # (as part of it if it is a space, else alone), so runs are cut there first with a mark that no text holds.
    mark = "\ue000"
    cut = f"regexp_replace(t, {lit(f'([{ws}])([^{ws}])')}, {lit(mark + chr(92) + '1' + chr(92) + '2')}, 'g')"
    pattern = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{ws}{word}]+|[{ws}]+"
    firsts = KEPT + """,
firsts AS (SELECT min(seq) AS seq, text FROM kept GROUP BY text),
spaced AS (SELECT seq, CASE WHEN text = '' OR text LIKE ' %' THEN text ELSE ' ' || text END AS t FROM firsts)"""
    return {
        "pretoken_counts": with_(
            firsts
            + f""",
pieces AS (SELECT unnest(string_split({cut}, {lit(mark)})) AS p FROM spaced),
words AS (SELECT unnest(regexp_extract_all(p, {lit(pattern)})) AS word FROM pieces)""",
            "SELECT word, count(*) AS cnt FROM words WHERE word <> '' GROUP BY word",
        ),
        "bpe_decode": with_(firsts, "SELECT seq, t AS text FROM spaced"),
    }


SQL.update(_tokenizer_sql())


def _first_merges_sql(merges: int = 40) -> dict[str, str]:
    """The tokenizer family over the first merges, learned by a recursive query.

    A word is its symbols' bytes in hex, each between bars; a merge is a
    replacement of two neighbours, from left to right.  Words of held-out
    documents only take part with count 0, so the last step encodes all.
    """
    from kiln.config import PackConfig, TokenizerConfig
    from kiln.operators.bpe import BPE_WS

    t, c = TokenizerConfig(), PackConfig()
    s = c.block_size
    ws, word, mark = BPE_WS, r"\p{L}\p{N}", "\ue000"
    cut = f"regexp_replace(t, {lit(f'([{ws}])([^{ws}])')}, {lit(mark + chr(92) + '1' + chr(92) + '2')}, 'g')"
    pattern = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{ws}{word}]+|[{ws}]+"
    names = ", ".join(f"({i}, {lit(x)}, {lit(x.encode().hex().upper())})" for i, x in enumerate(t.special_tokens))
    base = (
        "RECURSIVE " + KEPT + f""",
firsts AS (SELECT min(seq) AS seq, text FROM kept GROUP BY text),
pos AS (SELECT seq, text, (row_number() OVER (ORDER BY seq) - 1) // 64 AS shard FROM firsts),
sp AS (SELECT seq, text, CASE WHEN text = '' OR text LIKE ' %' THEN text ELSE ' ' || text END AS t,
              shard >= CAST(floor((SELECT max(shard) + 1 FROM pos) * (1 - {t.heldout_split})) AS INTEGER) AS held FROM pos),
dl AS (SELECT seq, list_filter(flatten(list_transform(string_split({cut}, {lit(mark)}),
         lambda p: regexp_extract_all(p, {lit(pattern)}))), lambda w: w <> '') AS ws FROM sp),
dw AS (SELECT seq, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM dl),
wc AS (SELECT word, count(*) FILTER (WHERE NOT held) AS cnt FROM dw JOIN sp USING (seq) GROUP BY word),
st AS (
  SELECT 0 AS step, word, cnt, regexp_replace(hex(encode(word)), '(..)', '|\\1|', 'g') AS s, ''::VARCHAR AS l, ''::VARCHAR AS r
  FROM wc
  UNION ALL
  SELECT st.step + 1, word, cnt, replace(s, '|' || b.l || '||' || b.r || '|', '|' || b.l || b.r || '|'), b.l, b.r
  FROM st, (
    SELECT l, r FROM (
      SELECT cnt, unnest(p[:-2]) AS l, unnest(p[2:]) AS r
      FROM (SELECT cnt, string_split(s[2:-2], '||') AS p FROM st WHERE cnt > 0 AND contains(s, '||')))
    GROUP BY l, r ORDER BY sum(cnt) DESC, l, r LIMIT 1) b
  WHERE st.step < {merges}
),
kb AS (SELECT b, printf('%02X', b) AS hex, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS shown FROM range(256) q(b)),
ch AS (SELECT hex, CASE WHEN shown THEN b ELSE 255 + row_number() OVER (PARTITION BY shown ORDER BY b) END AS cp FROM kb),
mg AS (SELECT DISTINCT step, l, r FROM st WHERE step > 0),
mh AS (SELECT step, unnest(regexp_extract_all(l || r, '..')) AS hex, generate_subscripts(regexp_extract_all(l || r, '..'), 1) AS k FROM mg),
tok AS (
  SELECT 3 + row_number() OVER (ORDER BY cp) AS id, hex, chr(cp::INTEGER) AS token FROM ch
  UNION ALL
  SELECT 259 + step, string_agg(hex, '' ORDER BY k), string_agg(chr(cp::INTEGER), '' ORDER BY k) FROM mh JOIN ch USING (hex) GROUP BY step
),
vocab AS (SELECT id, token FROM tok UNION ALL SELECT id, token FROM (VALUES {names}) n(id, token, hex)),
merges AS (SELECT step - 1 AS rank, a.id AS left_id, b.id AS right_id, 259 + step AS new_id
           FROM mg JOIN tok a ON a.hex = mg.l JOIN tok b ON b.hex = mg.r),
sy AS (SELECT word, string_split(s[2:-2], '||') AS p FROM st WHERE step = {merges}),
et AS (SELECT seq, i, unnest(p) AS hex, generate_subscripts(p, 1) AS k FROM dw JOIN sy USING (word)),
en AS (SELECT seq, i, k, id, token FROM et JOIN tok USING (hex)),
enc AS (SELECT seq, list(id ORDER BY i, k) AS ids, list(token ORDER BY i, k) AS tokens FROM en GROUP BY seq)"""
    )
    rows = base + f""",
fr AS (
  SELECT seq, sp.text, t, ids, tokens, len(ids) AS n_tokens, len({WORDS}) AS words, length(text) AS chars FROM sp JOIN enc USING (seq)
  WHERE held AND len({WORDS}) > 0 AND length(text) > 0
)"""
    packed = base + f""",
toks AS (SELECT seq, i, k, id FROM en UNION ALL SELECT seq, 2147483647, 0, {c.eos_id} FROM sp),
g AS (SELECT id, row_number() OVER (ORDER BY seq, i, k) - 1 AS gpos FROM toks),""" + _PACKED_TAIL
    pad = f"sum({s} - n_real)"
    total = "(train_tokens + val_tokens)"
    out = {
        "bpe_vocab": with_(base, "SELECT id::INTEGER AS id, token FROM vocab"),
        "bpe_merges": with_(base, "SELECT rank, left_id, right_id, new_id FROM merges"),
        "bpe_encode": with_(base, "SELECT seq, len(ids) AS n_tokens, array_to_string(ids, ',') AS ids FROM enc"),
        "token_counts": with_(base, "SELECT seq, len(ids) AS n_tokens FROM enc"),
        "bpe_contract": with_(
            base
            + """,
v AS (SELECT count(*) AS vocab_size, count(DISTINCT id) AS distinct_ids, count(DISTINCT token) AS distinct_tokens, max(id) AS max_id,
             max(id) FILTER (WHERE token = '<pad>') AS pad, max(id) FILTER (WHERE token = '<bos>') AS bos,
             max(id) FILTER (WHERE token = '<eos>') AS eos, max(id) FILTER (WHERE token = '<unk>') AS unk FROM vocab),
g AS (SELECT count(*) AS merges, max(greatest(left_id, right_id, new_id)) AS max_merge_id FROM merges),
e AS (SELECT max(list_max(ids)) AS max_encoded_id FROM enc)""",
            "SELECT v.*, g.*, e.*, distinct_ids = vocab_size AND distinct_tokens = vocab_size AND max_id = vocab_size - 1 "
            "AND max_merge_id < vocab_size AND max_encoded_id < vocab_size AND len(list_distinct([pad, bos, eos, unk])) = 4 AS contract_ok FROM v, g, e",
        ),
        "fertility": with_(
            rows
            + """,
lg AS (SELECT 'tokens_per_word' AS ratio, n_tokens / words::DOUBLE AS v FROM fr UNION ALL SELECT 'tokens_per_char', n_tokens / chars::DOUBLE FROM fr)""",
            "SELECT ratio, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS p90, "
            "max(n) AS documents, max(a) AS total_tokens, max(b) AS total_words, max(c) AS total_characters "
            "FROM lg, (SELECT count(*) AS n, sum(n_tokens) AS a, sum(words) AS b, sum(chars) AS c FROM fr) GROUP BY ratio",
        ),
        "worst_fertility": with_(
            rows,
            "SELECT seq, n_tokens AS tokens, words, chars, round(n_tokens / words::DOUBLE, 6) AS tokens_per_word, "
            "round(n_tokens / chars::DOUBLE, 6) AS tokens_per_char, substring(text, 1, 500) AS text, t AS decoded, "
            "array_to_string(tokens, ' ') AS token_strings, array_to_string(ids, ',') AS ids "
            "FROM fr ORDER BY n_tokens / words::DOUBLE DESC, seq LIMIT 20",
        ),
        "packed_blocks_bpe": with_(
            packed, "SELECT split, block, n_real, list_max(input_ids) AS max_id, array_to_string(input_ids, ',') AS input_ids FROM blocks"
        ),
        "packing_report_bpe": with_(
            packed
            + f""",
b AS (SELECT count(*) FILTER (WHERE split = 'train') AS train_blocks, count(*) FILTER (WHERE split = 'val') AS val_blocks,
             coalesce(sum(n_real) FILTER (WHERE split = 'train'), 0)::BIGINT AS train_tokens,
             coalesce(sum(n_real) FILTER (WHERE split = 'val'), 0)::BIGINT AS val_tokens, coalesce({pad}, 0)::BIGINT AS pad_tokens FROM blocks),
d AS (SELECT (SELECT count(*) FROM sp) AS documents, (SELECT count(*) FROM vocab) AS vocab_size)""",
            f"""SELECT documents, {total} AS tokens, documents AS eos_count, {s} AS block_size, train_blocks, val_blocks, train_tokens, val_tokens,
pad_tokens, round(100.0 * {total} / ((train_blocks + val_blocks) * {s}), 6) AS utilization_percent, vocab_size::INTEGER AS vocab_size,
{c.eos_id} AS eos_token_id, {c.pad_id} AS pad_token_id, {c.bos_id} AS bos_token_id, {c.train_split}::DOUBLE AS train_split,
round(100.0 * pad_tokens / ((train_blocks + val_blocks) * {s}), 6) AS pad_percentage,
round({total} / documents::DOUBLE, 6) AS avg_tokens_per_doc,
round({total} / (train_blocks + val_blocks)::DOUBLE, 6) AS avg_tokens_per_block FROM b, d""",
        ),
    }
    return {f"{name}_first_merges": sql for name, sql in out.items()}


SQL.update(_first_merges_sql())



def _log_sql() -> dict[str, str]:
    log = """
WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS run, event_id AS step, value + 1 AS train_loss, value AS val_loss FROM events
)"""
    return {
        "run_log": log + " SELECT CAST(CAST(run AS BIGINT) % 20 AS VARCHAR) AS run, step, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM log",
        "loss_curves": log + " SELECT run, step, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM log",
        "run_best": log
        + """,
w AS (SELECT *, min(val_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM log)
SELECT run, step, coalesce(val_loss < b, true) AS improved, round(least(val_loss, coalesce(b, val_loss)), 6) AS best_so_far FROM w""",
        "run_throughput": log + " SELECT run, step, round(32768.0::DOUBLE / (1 + step % 7), 6) AS tokens_per_second FROM log",
        "eval_steps": log + " SELECT run, step, round(val_loss, 6) AS val_loss FROM log WHERE step % 100 = 0",
    }


SQL.update(_log_sql())
SQL["json_report"] = SQL["drop_reasons"]
SQL["packed_source"] = SQL["packed_blocks"]
SQL["packed_sink"] = SQL["packed_blocks"].split("\nSELECT split, block, n_real, array_to_string")[0] + "\nSELECT split, block, n_real, len(input_ids) AS n_ids FROM blocks"
SQL["filtered_shards"] = with_(
    METRICS + "," + _shard_positions(64), "SELECT sh.shard, sh.seq, sh.doc_id, sh.token_count FROM sh JOIN m ON m.seq = sh.seq WHERE m.passed"
)
_N = "n_chars * pow(1024.0, doc_id % 6)"
_UNITS = ["B", "KB", "MB", "GB", "TB"]
SQL["format_bytes"] = (
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN {_N} < {1024 ** (i + 1)} THEN printf('%.2f {u}', {_N} / {1024**i}::DOUBLE)" for i, u in enumerate(_UNITS))
    + f" ELSE printf('%.2f PB', {_N} / {1024**5}::DOUBLE) END AS size FROM documents"
)
