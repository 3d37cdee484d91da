"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_BENCHMARK_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
b AS (SELECT item_id, {_BENCHMARK_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark),
bw AS (
    SELECT item_id, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i, w
    FROM b WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT k FROM windows),
dw AS (SELECT doc_id, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= k),
hits AS (
    SELECT dw.doc_id, dw.i, dw.k, windows.item_id
    FROM dw JOIN windows ON dw.k = windows.k AND array_to_string(dw.w[dw.i:dw.i + dw.k - 1], ' ') = windows.s
),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY 1),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE = {"op1_decontaminate": OP1}

_HOST = r"translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's')"
OP6 = f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
listed AS (SELECT DISTINCT host || path AS key FROM p WHERE regexp_matches(host, 'casino|pills|bets')),
fit AS (
    SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v
    FROM (SELECT DISTINCT page_id, host, path FROM p) p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(v, CASE WHEN key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, key IS NOT NULL AS listed
FROM p LEFT JOIN fit USING (page_id) LEFT JOIN listed ON key = host || path
"""
OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html)::BIGINT AS n, sha1(html) AS d FROM p),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) END AS last FROM s)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
    CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to
FROM m
"""

ORACLE |= {"op6_url_filter": OP6, "op8_warc": OP8}
