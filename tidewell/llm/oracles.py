"""DuckDB SQL for operators that plain SQL can express, by brute force: no signatures, prefixes or indexes."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Near-duplicate classes: all pairs of documents that share a shingle, and what they reach.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT k, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d
), n AS (SELECT k, count(*) AS n FROM s GROUP BY k), links AS (
    SELECT a.k AS a, b.k AS b FROM s a JOIN s b ON a.g = b.g AND a.k <> b.k JOIN n x ON x.k = a.k JOIN n y ON y.k = b.k
    GROUP BY a.k, b.k, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (SELECT k AS a, k AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (k) JOIN reach r ON r.a = d.k JOIN d o ON o.k = r.b GROUP BY d.k, d.doc_id, n.n
"""

#: Contamination: every window of 13 words (or a shorter item) looked up at every place, and by proximity from its rarest word.
CONTAMINATION = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT coalesce(item_id::VARCHAR, 'null') AS item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), v AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS terms, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)
), p AS (
    SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)
), m AS (SELECT p.k, p.i, p.n, v.item_id FROM p JOIN v ON v.n = p.n AND v.g = p.g),
h AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS place FROM m) GROUP BY k),
t AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM m GROUP BY k),
post AS (SELECT k, unnest(w) AS term, unnest(range(len(w))) AS at FROM d), often AS (SELECT term, count(*) AS often FROM post GROUP BY term),
vt AS (SELECT item_id, g, n, unnest(terms) AS term, unnest(range(n)) AS place FROM v),
rare AS (SELECT item_id, g, n, arg_min(term, (often, place)) AS term FROM vt JOIN often USING (term) GROUP BY item_id, g, n HAVING count(*) = n),
cand AS (SELECT r.item_id, r.g, r.n, q.k, q.at FROM rare r JOIN post q USING (term)),
near AS (
    SELECT DISTINCT c.item_id, c.k FROM cand c JOIN vt ON vt.item_id = c.item_id AND vt.g = c.g JOIN post q ON q.k = c.k AND q.term = vt.term AND q.at BETWEEN c.at - c.n - 6 AND c.at + c.n + 6
    GROUP BY c.item_id, c.g, c.n, c.k, c.at HAVING count(DISTINCT vt.place) = c.n
), x AS (SELECT k, count(*) AS n_near FROM near GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k) LEFT JOIN x USING (k)
"""
