"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP8_MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
k AS (SELECT *, md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([5.0, 2.0, 1.0]::DOUBLE[], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size / w AS ratio,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY 3 * source_size / w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(source_size) OVER () AS total
  FROM s),
l AS (SELECT coalesce(arg_min((total - held) / free, ratio) FILTER ((total - held) / free <= ratio), 0) AS level FROM r),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, level * w)::DOUBLE AS target FROM s, l),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
q AS (
  SELECT k.doc_id, k.size, g.source_size, g.target, g.epochs,
         greatest(floor(g.target)::BIGINT - g.epochs * g.source_size, 0) AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key) AS upto,
         sum(k.size) OVER (PARTITION BY k.source, k.key) AS tied,
         count(*) OVER (PARTITION BY k.source, k.key) AS copies
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN upto <= rest THEN size
                             WHEN upto - tied >= rest THEN 0
                             ELSE least(size, (rest - upto + tied) // copies) END)::BIGINT AS taken
FROM q
"""

OP11_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
lt AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + lt.v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (k.n + 1)) // (lt.total + lt.v))::BIGINT AS q
  FROM g JOIN kept k ON k.lang = g.lang JOIN lt ON lt.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP12_HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.label <> p.anchor_label AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 3
"""

LLM_ORACLE: dict[str, str] = {"op8_mixing": OP8_MIXING, "op11_divergence": OP11_DIVERGENCE,
                              "op12_hard_negatives": OP12_HARD_NEGATIVES}
