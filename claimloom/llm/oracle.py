"""SQL with the same results, for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH texts AS (
    SELECT DISTINCT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest
    FROM documents
), copies AS (
    SELECT digest, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY digest
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       digest AS text_sha256
FROM texts JOIN copies USING (digest)
"""


NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(
            range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
        END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n + b.n) AS both_sizes, count(*) AS common
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared WHERE 100 * common >= 85 * (both_sizes - common)
    UNION ALL
    SELECT y, x FROM shared WHERE 100 * common >= 85 * (both_sizes - common)
), reach AS (
    SELECT x, y FROM links
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), lowest AS (
    SELECT x, min(y) AS low FROM reach GROUP BY x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce(low, doc_id)) AS component_id
FROM sets LEFT JOIN lowest ON doc_id = x
"""


URL_RULES = r"""
WITH rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), urls AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
), best AS (
    SELECT u.host, u.path, r.host || r.path AS rule, r.verdict
    FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules r
        ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    QUALIFY row_number() OVER (
        PARTITION BY u.host, u.path ORDER BY length(r.host || r.path) DESC) = 1
)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls u LEFT JOIN best b ON u.host = b.host AND u.path = b.path
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op4_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
        "op12_url_rules": URL_RULES,
    }
