"""DuckDB twins of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from shopsignals.llm.quality_rules import STOP_WORDS

_STOPS = ", ".join("'" + w + "'" for w in sorted({w for line in STOP_WORDS for w in line.split()}))

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
s AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(cov.n, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
    len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stops
  FROM d LEFT JOIN cov USING (doc_id)),
r AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_word_ratio,
    n_stops / greatest(n_words, 1) AS stop_word_ratio,
    (len(lines) - len(list_distinct(lines))) / greatest(len(lines), 1) AS duplicate_line_ratio,
    n_upper / greatest(word_chars, 1) AS upper_char_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND n_words >= 50 AND mean_word_chars BETWEEN 2 AND 12 AND symbol_word_ratio <= 0.1 AND stop_word_ratio >= 0.02
    AND duplicate_line_ratio <= 0.5 AND upper_char_ratio <= 0.4 AS kept,
  mean_word_chars, symbol_word_ratio, stop_word_ratio, duplicate_line_ratio, upper_char_ratio
FROM r"""

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, i, l[i + 1] AS raw,
    regexp_replace(trim(regexp_replace(l[i + 1], '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m
  FROM (SELECT doc_id, l, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
tok AS (SELECT doc_id, m, string_split(m, ' ') AS w FROM (SELECT DISTINCT doc_id, m FROM line WHERE m <> '')),
keyed AS (SELECT doc_id, m, w, len(w) || ' ' || array_to_string(w[1:4], ' ') AS leaf FROM tok WHERE NOT regexp_matches(m, '^<[*]>( <[*]>)*$')),
keys AS (SELECT leaf, m, any_value(w) AS w, count(*) AS held, min(doc_id) AS first, max(doc_id) AS last FROM keyed GROUP BY leaf, m),
cell AS (SELECT leaf, m, held, len(w) - 4 AS r, p, w[p] AS token FROM (SELECT leaf, m, w, held, unnest(range(5, len(w) + 1)) AS p FROM keys)),
support AS (SELECT leaf, p, token, sum(held) AS s FROM cell GROUP BY leaf, p, token HAVING count(*) > 1),
ranked AS (
  SELECT leaf, m, held, r, row_number() OVER o AS kept, list(p || ':' || token) OVER o AS tokens
  FROM cell JOIN support USING (leaf, p, token)
  WINDOW o AS (PARTITION BY leaf, m ORDER BY s DESC, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
candidate AS (SELECT leaf, m, held, kept, leaf || '|' || array_to_string(list_sort(tokens), ' ') AS family FROM ranked WHERE kept * 10 >= r * 8),
common AS (SELECT family, sum(held) AS n FROM candidate GROUP BY family HAVING count(*) > 1),
best AS (SELECT leaf, m, family FROM candidate JOIN common USING (family) QUALIFY row_number() OVER (PARTITION BY leaf, m ORDER BY n DESC, kept DESC) = 1),
named AS (
  SELECT k.leaf, k.m, first, last, b.m IS NOT NULL AS general, coalesce(b.family, k.m) AS family
  FROM keys k LEFT JOIN best b ON k.leaf = b.leaf AND k.m = b.m),
kept AS (
  SELECT family, general, min(first) AS keeper FROM named GROUP BY family, general HAVING max(last) > min(first)),
drops AS (SELECT m, keeper FROM named JOIN kept USING (family, general)),
flagged AS (SELECT line.*, coalesce(keeper <> doc_id, false) AS gone FROM line LEFT JOIN drops USING (m))
SELECT doc_id, count(*) AS n_lines, count(CASE WHEN gone THEN 1 END) AS n_dropped,
  coalesce(string_agg(CASE WHEN gone THEN CAST(i AS VARCHAR) END, ',' ORDER BY i), '') AS dropped,
  CAST(length(coalesce(string_agg(CASE WHEN NOT gone THEN raw END, chr(10) ORDER BY i), '')) AS BIGINT) AS n_chars_left,
  md5(coalesce(string_agg(CASE WHEN NOT gone THEN raw END, chr(10) ORDER BY i), '')) AS text_md5
FROM flagged GROUP BY doc_id"""


def _field(name: str) -> str:
    return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: bit by bit CRC-32 of the ids, trees level by level, and each leaf's walk along its siblings
MERKLE_MANIFEST = f"""
WITH RECURSIVE
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc AS (
  SELECT doc_id, s, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL
  SELECT doc_id, s, k + 1, xor(b >> 1, (b & 1) * CAST(3988292384 AS BIGINT))
  FROM (SELECT doc_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(s[k // 8 + 1]) AS BIGINT)) ELSE c END AS b FROM crc WHERE k < 8 * length(s))),
tampered AS (SELECT doc_id FROM crc WHERE k = 8 * length(s) AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0),
leaf AS (
  SELECT d.doc_id, d.lang, {_leaf('n_chars')} AS leaf, CASE WHEN t.hit IS NOT NULL THEN {_leaf('(n_chars + 1)')} END AS claim
  FROM documents d LEFT JOIN (SELECT doc_id AS hit FROM tampered) t ON d.doc_id = t.hit),
placed AS (
  SELECT *, row_number() OVER () AS rid, CAST(dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS tree,
    CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos,
    count(*) OVER (PARTITION BY lang) AS m
  FROM leaf),
node AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, m FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (m + 1) // 2 FROM node WHERE m > 1 GROUP BY tree, lvl, m, pos // 2),
depth AS (SELECT tree, max(lvl) AS lvl FROM node GROUP BY tree),
sub AS (SELECT tree, h AS subroot, count(*) OVER () AS m FROM node WHERE m = 1),
top AS (
  SELECT 0 AS lvl, tree AS pos, subroot AS h, m FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (m + 1) // 2 FROM top WHERE m > 1 GROUP BY lvl, m, pos // 2),
walk AS (
  SELECT rid, tree, 0 AS lvl, pos, '' AS proof, coalesce(claim, leaf) AS f FROM placed
  UNION ALL
  SELECT w.rid, w.tree, w.lvl + 1, w.pos // 2, w.proof || coalesce(s.h, ''),
    sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.h, '') || w.f ELSE w.f || coalesce(s.h, '') END)
  FROM walk w JOIN depth d ON w.tree = d.tree AND w.lvl < d.lvl
  LEFT JOIN node s ON s.tree = w.tree AND s.lvl = w.lvl AND s.pos = xor(w.pos, CAST(1 AS BIGINT))),
climb AS (
  SELECT w.rid, 0 AS lvl, w.tree AS pos, w.proof, w.f FROM walk w JOIN depth d ON w.tree = d.tree AND w.lvl = d.lvl
  UNION ALL
  SELECT w.rid, w.lvl + 1, w.pos // 2, w.proof || coalesce(s.h, ''),
    sha256(CASE WHEN w.pos % 2 = 1 THEN coalesce(s.h, '') || w.f ELSE w.f || coalesce(s.h, '') END)
  FROM climb w JOIN (SELECT max(lvl) AS lvl FROM top) d ON w.lvl < d.lvl
  LEFT JOIN top s ON s.lvl = w.lvl AND s.pos = xor(w.pos, CAST(1 AS BIGINT))),
fin AS (SELECT c.* FROM climb c JOIN (SELECT max(lvl) AS lvl FROM top) d ON c.lvl = d.lvl),
root AS (SELECT h FROM top WHERE m = 1)
SELECT p.doc_id, p.leaf, sub.subroot, root.h AS root, sha256(fin.proof) AS proof_sha256, fin.f AS folded_root, fin.f = root.h AS verified
FROM placed p JOIN sub USING (tree) JOIN fin ON fin.rid = p.rid, root"""
