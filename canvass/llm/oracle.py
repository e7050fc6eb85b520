"""SQL that gives the rows of those queries that SQL can express."""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY 1),
hits AS (SELECT doc_id, i FROM win JOIN firsts USING (k) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i, TRUE AS g FROM hits),
t AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM w),
marked AS (SELECT t.doc_id, t.i, word, coalesce(g, FALSE) AS g FROM t LEFT JOIN gone ON t.doc_id = gone.doc_id AND t.i = gone.i),
edges AS (SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM marked),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE g) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT g) AS kept, count(*) FILTER (WHERE opens) AS n_spans
  FROM edges GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS INT) AS n_spans
FROM documents d LEFT JOIN sums USING (doc_id)
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BENCHMARK_HITS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
bs AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM bs),
sizes AS (SELECT DISTINCT n FROM bw),
ds AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k FROM ds),
hits AS (SELECT doc_id, dw.i, bw.n, item FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY 1),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, r, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
s AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS total, coalesce(v, 0) AS v FROM g LEFT JOIN v USING (lang)),
f AS (
  SELECT s.lang, s.source, kept.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
  FROM s JOIN kept USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM f GROUP BY 1, 2),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source),
terms AS (SELECT f.lang, f.source, 'term' AS part, f.term AS item, p - q AS value FROM f JOIN l ON f.lang = l.lang AND f.term = l.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

LEXICAL_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS words FROM d WHERE len(ws) > 0),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM q GROUP BY 1, 2),
p AS (SELECT r, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM d),
t AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3, 4),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, docs),
f AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
      FROM t JOIN w USING (term) JOIN asked USING (term), s GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM f WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
