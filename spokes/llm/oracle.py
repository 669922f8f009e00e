"""DuckDB twins of the queries that SQL can express, over whole tables and texts."""

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words(source: str, key: str) -> str:
    lowered = f"translate(coalesce(text, ''), {LETTERS})"
    return f"SELECT {key}, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {source}"


OP3 = f"""
WITH d AS ({_words("documents", "doc_id")}),
i AS ({_words("benchmark", "item_id")}),
win AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, ws[s:s + least(10, len(ws)) - 1] AS g
    FROM i, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS t(s) WHERE len(ws) > 0
),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
here AS (SELECT doc_id, s, n, ws[s:s + n - 1] AS g FROM d, sizes, unnest(range(1, len(ws) - n + 2)) AS t(s)),
hit AS (SELECT DISTINCT doc_id, s, n, item FROM here JOIN win USING (g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP9 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, ws[s:s + 12] AS g FROM d, unnest(range(1, len(ws) - 11)) AS t(s)),
first AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps
    FROM win JOIN first USING (g), unnest(range(s, s + 13)) AS t(p) WHERE f < doc_id GROUP BY doc_id
),
word AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d
),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS text
    FROM word LEFT JOIN (SELECT doc_id, unnest(ps) AS p, true AS out FROM gone) USING (doc_id, p)
    WHERE out IS NULL GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# CRC-32 of a short ASCII string: every byte goes through eight steps of the reflected polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(s, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
        lambda r, k: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

OP13 = f"""
WITH coded AS (
    SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS p FROM coded),
c AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
r AS (
    SELECT c.conv_id, p, code, words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
    UNION ALL SELECT conv_id, p, code, words FROM c JOIN t USING (conv_id) WHERE p > h
),
s AS (
    SELECT conv_id, coalesce(any_value(codes), []) AS codes, coalesce(any_value(ws), []) AS ws
    FROM c LEFT JOIN (SELECT conv_id, list(code ORDER BY p) AS codes, list(words ORDER BY p) AS ws FROM r GROUP BY conv_id)
    USING (conv_id) GROUP BY conv_id
),
node AS (
    SELECT codes[1:d] AS k, d AS depth, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(ws[d]), 0) AS w,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len(codes)), '') AS ends
    FROM s, unnest(range(0, len(codes) + 1)) AS u(d) GROUP BY k, depth
),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT n.k[1:d] AS k, sum((n - 1) * w) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS leaves
    FROM node n LEFT JOIN kids ON kids.k = n.k, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN below ON below.k = n.k LEFT JOIN kids ON kids.k = n.k
LEFT JOIN node up ON n.depth > 0 AND up.k = n.k[1:n.depth - 1]"""
