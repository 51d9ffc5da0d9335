"""DuckDB SQL for the operators that SQL can express, written independently of the Spark code."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN win ON dw.g = win.g AND dw.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [
    ("assign", _ASSIGN, 2, 6), ("access", "(AKIA[A-Z0-9]+)", 1, 20), ("hex", "([0-9a-f]+)", 1, 24),
    ("github", "(gh[pousr]_[A-Za-z0-9]+)", 1, 40), ("jwt", r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1, 20),
    ("pem", "(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 0),
]


def _kind(no: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Places from the lengths of the matches and of what lies between them."""
    return rf"""
  SELECT doc_id, {no} AS k, '{kind}' AS kind, s, s + len(m[i]) AS e FROM (
    SELECT *, list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v,
             string_split(regexp_replace(t, '{pattern}', chr(1), 'g'), chr(1)) AS gaps FROM t)))
  WHERE len(v[i]) >= {least}"""


OP10 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
span AS ({" UNION ALL ".join(_kind(n, *k) for n, k in enumerate(_KINDS))}),
listed AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) AS spans
  FROM span GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

ORACLE_SQL = {"op5_jaccard_join": OP5, "op7_decontamination": OP7, "op10_secret_scans": OP10}
