"""SQL for the operators that SQL can express."""

JACCARD_JOIN = r"""
WITH RECURSIVE
d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
),
s AS (
    SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS shingle
    FROM (SELECT r, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)
),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.r < b.r GROUP BY 1, 2),
link AS (
    SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)
),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(c.least AS BIGINT) AS component_id
FROM d LEFT JOIN n USING (r)
JOIN (SELECT reach.a AS r, min(d.doc_id) AS least FROM reach JOIN d ON d.r = reach.b GROUP BY 1) c USING (r)
"""

REPEATED_PASSAGES = r"""
WITH
d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
),
w AS (
    SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS passage
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)
),
twice AS (SELECT passage FROM w GROUP BY passage HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM w JOIN twice USING (passage)),
word AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
kept AS (
    SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM word ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


FILTER_AUDIT = r"""
WITH
d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
),
f AS (
    SELECT part,
           CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) THEN 'E' ELSE '' END AS fails,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS toxic
    FROM d
),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || e.x || z.x AS filter_order
    FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x)
    JOIN letter e ON e.x NOT IN (a.x, b.x, c.x) JOIN letter z ON z.x NOT IN (a.x, b.x, c.x, e.x)
),
steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter, substr(filter_order, 1, step - 1) AS before
    FROM orders, unnest(range(1, 6)) t(step)
),
counted AS (
    SELECT part, filter_order, step, filter,
           sum(CASE WHEN len(early) = 0 AND NOT contains(fails, filter) THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN len(early) = 0 AND contains(fails, filter) THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN len(early) > 0 AND contains(fails, filter) THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN len(early) = 0 AND contains(fails, filter) THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN len(early) = 0 AND contains(fails, filter) THEN toxic ELSE 0 END) AS toxic_lost
    FROM (SELECT *, list_filter(string_split(before, ''), lambda c: c <> '' AND contains(fails, c)) AS early FROM g, steps)
    GROUP BY ALL
)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""
