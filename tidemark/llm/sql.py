"""SQL for operators that it can express: by all windows and by all pairs, which Spark is spared."""

from __future__ import annotations

REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT r, p, hash(substr(h, 2 * p + 1, 800)) AS k
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS p FROM d)
),
hit AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
edge AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400 AS goes_on FROM hit),
run AS (SELECT r, p, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g FROM edge),
span AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM run GROUP BY r, g),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS until FROM span),
gone AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * until + 1, 2 * (a - until)), '' ORDER BY a) AS kept
  FROM cut JOIN d USING (r) GROUP BY r
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""

LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings
),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 END
),
reach(u, w) AS (SELECT u, w FROM link UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u)
SELECT vec_id, (SELECT count(*) FROM link WHERE u = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id) AS kept
FROM v
"""
