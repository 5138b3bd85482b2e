"""SQL of the queries that SQL can express, over whole tables and whole texts."""

# Words of a text in SQL, as decontamination takes them.
_PLAIN = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT item, w[i:i + least(len(w), 10) - 1] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, n, i, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item FROM places JOIN windows USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id
), items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 12] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), least_id AS (SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win),
hit AS (SELECT doc_id, i FROM windows JOIN least_id USING (win) WHERE doc_id > first_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS places FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(places, j)), lambda j: w[j]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

TOP_K = """
WITH good AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM good),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS line, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.line AS anchor, a.vec_id AS anchor_id, c.line, c.vec_id, a.label = c.label AS alike,
    CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.line <> a.line AND len(a.e) = len(c.e)
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM scored WHERE alike
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.line ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.alike
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE place <= 10
"""

ORACLES = {
    "op4_decontamination": DECONTAMINATION,
    "op5_substrings": SUBSTRINGS,
    "op6_topk": TOP_K,
    "op12_negatives": NEGATIVES,
}
