"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP9 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
    FROM pages
), g AS (
    SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id,
        list_transform(range(0, 8), lambda i: ('0x' || substr(h, 5 * i::INT + 1, 5))::INT) AS v
    FROM p
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(v, lambda x:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 15) & 31)::INT, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 10) & 31)::INT, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 5) & 31)::INT, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (x & 31)::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM g
"""

OP4 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
          FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0))
), dw AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
), m AS (
    SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, g)
), h AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY ALL
), n AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY ALL
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP1 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY ALL
), l AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL)
    JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), e AS (
    SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY ALL
"""

#: The word versions of op8; SQL has no byte-level BPE.
OP8_WORDS = r"""
WITH copies AS (
    SELECT text, min(doc_id) AS first_id FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) GROUP BY ALL
), kept AS (
    SELECT source, lang, regexp_replace(coalesce(d.text, ''), '(?m)^Licensed under .*$', '', 'g') AS text
    FROM documents d JOIN copies c ON coalesce(d.text, '') = c.text AND d.doc_id = c.first_id
), counted AS (
    SELECT source, lang, 'words@1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM kept
    UNION ALL
    SELECT source, lang, 'words@2',
        len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS docs, sum(n)::BIGINT AS tokens FROM counted GROUP BY ALL
"""
