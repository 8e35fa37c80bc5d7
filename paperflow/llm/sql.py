"""DuckDB SQL of the registered queries, written out on its own (no constant is imported)."""

OP6 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY bare) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

OP8 = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, t) AS said,
         coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (WHERE role = 'assistant'), '') AS loss,
         -- each of \ < [ is escaped by one more character; the marks' lengths by role
         CAST(sum(2 * length(t) - length(translate(t, '\<[', ''))
             + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 END) AS BIGINT) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""

OP11 = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS s(k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
x AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, n.n, j,
         (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM c, range(1, 5) AS s(j)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
  JOIN n ON n.lang = c.lang
  WHERE j < c.k),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
z AS (SELECT * FROM y WHERE NOT EXISTS (
        SELECT 1 FROM c WHERE c.lang = y.lang AND c.phrase <> y.phrase AND contains(' ' || c.phrase || ' ', ' ' || y.phrase || ' ')
                        AND 100 * c.a >= 100 * y.a))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
       phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM z QUALIFY rank <= 2000
"""

OP12 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (
  SELECT doc_id, i, word, string_agg(word, ' ') OVER n20 AS said, count(*) OVER n20 AS n
  FROM p WINDOW n20 AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT *, n = 20 AND row_number() OVER (PARTITION BY n, said ORDER BY doc_id, i) > 1 AS again FROM s),
c AS (
  SELECT doc_id, i, word,
         bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM r),
k AS (SELECT doc_id, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
      FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

QUERIES = {"op11_collocations": OP11, "op12_hard_negatives": OP12, "op13_substring_dedup": OP13, "op6_exact_dedup": OP6, "op8_chat_formatting": OP8}
