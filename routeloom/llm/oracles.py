"""SQL that must agree with the two exact matching operators.  Quadratic in places: for small tables."""

#: Every 50-byte window of every text as hexadecimal, grouped.
OP4_SQL = r"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, i, substr(x, 2 * i - 1, 100) AS g FROM (SELECT doc_id, x, unnest(range(1, CAST(length(x) / 2 AS BIGINT) - 48)) AS i FROM h)),
m AS (SELECT g, min(doc_id) AS low FROM p GROUP BY g HAVING min(doc_id) <> max(doc_id)),
k AS (SELECT p.doc_id, p.i FROM p JOIN m ON p.g = m.g WHERE p.doc_id > m.low),
o AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM k),
q AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM o),
sp AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM q GROUP BY doc_id, span),
gap AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS a, a AS b FROM sp
        UNION ALL SELECT h.doc_id, coalesce(max(sp.b), 1), CAST(max(length(x)) / 2 AS BIGINT) + 1 FROM h LEFT JOIN sp ON h.doc_id = sp.doc_id GROUP BY h.doc_id),
kept AS (SELECT h.doc_id, coalesce(string_agg(substr(x, CAST(2 * a - 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a), '') AS y FROM h JOIN gap ON h.doc_id = gap.doc_id GROUP BY h.doc_id),
t AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM sp GROUP BY doc_id)
SELECT h.doc_id, CAST(length(x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(y)) AS kept_sha256
FROM h JOIN kept ON h.doc_id = kept.doc_id LEFT JOIN t ON h.doc_id = t.doc_id
"""

#: All pairs that share a shingle, then links, then reachability.
OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM d JOIN r ON d.doc_id = r.a LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""
