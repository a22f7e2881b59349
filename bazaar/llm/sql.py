"""DuckDB oracles of the operators that SQL can express."""
from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op4_chat_formatting"] = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, count(*) AS n,
             list('<|' || role || '|>' || chr(10) || text || chr(10) ORDER BY turn, role, text) AS parts
      FROM t GROUP BY conv_id),
whole AS (SELECT min(conv_id) AS conv_id, n, parts, count(*) AS copies FROM c GROUP BY n, parts)
SELECT conv_id, CAST(0 AS BIGINT) AS chunk, n AS n_turns, copies, array_to_string(parts, '') AS rendered
FROM whole w
WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.n > w.n AND d.parts[1] = w.parts[1] AND d.parts[1:w.n] = w.parts)
"""

SQL["op8_topk_search"] = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

SQL["op11_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
             CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
w AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM w WHERE rank <= 3
"""

# crc32 by its table (from the rule of the reversed polynomial), near words by the strings that one deletion
# or one masked code point leaves, roots by walking the forms
SQL["op13_spelling_variants"] = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))
              ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[a-z\u00C0-\u00FF]+')) AS run
         FROM documents WHERE text IS NOT NULL),
seen AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295,
                  [CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * CAST(k AS INTEGER) + 1, 2) AS BIGINT)
                   FOR k IN range(octet_length(encode(id || ':' || run)))]),
                  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h
           FROM seen, crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                    ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.mask = b.mask AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word),
counts AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
best AS (SELECT word, other, other_n FROM near
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS MATERIALIZED (
  SELECT w.word, CASE WHEN other_n >= 5 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN counts USING (word) LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS here, 0 AS step FROM forms
         UNION ALL SELECT walk.word, forms.form, step + 1 FROM walk JOIN forms ON forms.word = walk.here WHERE forms.form IS NOT NULL)
SELECT forms.word, form, last.here AS root, n, n_near, CAST(form_n AS DOUBLE) AS form_n
FROM forms JOIN (SELECT word, here FROM walk QUALIFY row_number() OVER (PARTITION BY word ORDER BY step DESC) = 1) last USING (word)
"""
