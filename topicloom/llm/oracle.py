"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op11_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, upper(sha1(body)) AS hex FROM p
), b AS (
  SELECT *, list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * g, 5) AS BIGINT) >> s) & 31 AS BIGINT), 1)
  ), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last
  FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM b
"""

# crc32 by its definition: eight shifts for each byte, the polynomial where the lowest bit is set.
ORACLE["op12_spelling"] = """
WITH RECURSIVE crc_of AS (
  SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
  FROM range(256) t(b)
), steps AS (
  SELECT list(v ORDER BY b) AS v FROM crc_of
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM counted
), hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(1, 1 + CAST(octet_length(encode(s)) AS BIGINT)), lambda i:
      CAST('0x' || substr(hex(encode(s)), 2 * i - 1, 2) AS BIGINT))),
    lambda x, b: xor(x >> 8, v[1 + (xor(x, b) & 255)]))) AS h
  FROM bytes, steps
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, c FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), holes AS (
  SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS hole
  FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.k = b.k AND a.hole = b.hole AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.hole = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.hole = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(CASE WHEN m = top THEN other END) AS form
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word
), forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN m >= 10 * n THEN form END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS go FROM forms
  UNION ALL
  SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON walk.go = forms.word
)
SELECT f.word, f.form, walk.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN walk ON walk.word = f.word AND walk.go IS NULL
"""

ORACLE["op13_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_count(embedding) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
    CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), pos AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), neg AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""
