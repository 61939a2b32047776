"""SQL of the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

from gridmart.llm.licenses import NOTICES, PERCENT, PHRASES

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))), 1, 16) AS row_key
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, substr(md5(row_key || '|' || n::VARCHAR), 1, 16) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, row_key) AS n FROM sized)
), sources AS (
  SELECT *, 3 * source_size / weight AS full_at
  FROM (
    SELECT source, sum(size)::BIGINT AS source_size,
      1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM placed GROUP BY source
  )
), rates AS (
  SELECT *, (
    (SELECT sum(source_size) FROM sources)
    - coalesce((SELECT sum(3 * b.source_size) FROM sources b WHERE b.full_at < a.full_at), 0)
  )::DOUBLE / (SELECT sum(c.weight) FROM sources c WHERE c.full_at >= a.full_at)::DOUBLE AS rate
  FROM sources a
), targets AS MATERIALIZED (
  SELECT source, source_size,
    least(3.0::DOUBLE * source_size, weight * (SELECT max(rate) FROM rates WHERE rate <= full_at)) AS target
  FROM rates
), served AS (
  SELECT p.*, t.source_size, t.target,
    sum(p.size) OVER (PARTITION BY p.source ORDER BY p.place, p.row_key, p.n ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
), queued AS (
  SELECT *, (copy * source_size + upto) / target AS finish
  FROM served, (VALUES (0), (1), (2)) AS c(copy) WHERE size > 0
), cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, row_key, n, copy ROWS UNBOUNDED PRECEDING) AS sent
  FROM queued
), taken AS (
  SELECT place, row_key, n, count(*) AS copies FROM cut
  WHERE sent <= (SELECT sum(size) FROM placed) GROUP BY ALL
)
SELECT s.doc_id, s.size, s.source_size, s.target, coalesce(t.copies, 0)::INTEGER AS copies,
  (s.size * coalesce(t.copies, 0))::BIGINT AS taken
FROM served s LEFT JOIN taken t USING (place, row_key, n)
"""

JACCARD = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
    END AS shingles
  FROM split
), sizes AS MATERIALIZED (
  SELECT doc_id, len(shingles)::BIGINT AS n FROM sets
), tokens AS MATERIALIZED (
  SELECT doc_id, unnest(shingles) AS token FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), near AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN near l ON r.other = l.a
)
SELECT doc_id, n AS n_shingles, (SELECT min(other) FROM reached r WHERE r.doc_id = s.doc_id) AS component_id
FROM sizes s
"""

_TEMPLATES = ", ".join(
    f"('{t.label}', {str(t.is_phrase).upper()}, '{t.text}')" for t in (*PHRASES, *NOTICES)
)

LICENSES = rf"""
WITH templates AS (
  SELECT t, label, is_phrase, w, list_distinct(w) AS distinct_words, len(w) AS length
  FROM (
    SELECT row_number() OVER () AS t, label, is_phrase, regexp_extract_all(lower(body), '[0-9a-z]+') AS w
    FROM (VALUES {_TEMPLATES}) AS v(label, is_phrase, body)
  )
), texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS MATERIALIZED (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts
), places AS (
  SELECT r, label, i FROM words JOIN templates t ON is_phrase AND word = t.w[1] JOIN texts x USING (r)
  WHERE x.w[i + 1 : i + length] = t.w
), blocks AS (
  SELECT r, t, label, (i // length) - back AS block, len(any_value(distinct_words)) AS size,
    count(DISTINCT word) AS shared
  FROM words JOIN (SELECT *, unnest(distinct_words) AS word FROM templates WHERE NOT is_phrase) USING (word),
    (VALUES (0), (1)) AS v(back)
  WHERE (i // length) >= back GROUP BY ALL
), notices AS (
  SELECT r, label, shared::DOUBLE / size::DOUBLE AS containment FROM blocks WHERE 100 * shared >= {PERCENT} * size
), base AS (
  SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY r
), every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(containment) AS score
  FROM (SELECT r, label, containment FROM notices UNION ALL SELECT r, label, 1.0::DOUBLE FROM places) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word,
  b.last_word::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels,
  coalesce(e.score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN base b USING (r) LEFT JOIN every e USING (r)
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS t
    FROM documents
  )
), start AS MATERIALIZED (
  SELECT lang, w, len(w) AS size, unnest(range(1, len(w) + 1)) AS i FROM piece
), f AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS c,
    count(*) FILTER (i > 1) AS n_left, count(*) FILTER (i + k - 1 < size) AS n_right
  FROM start, (VALUES (1), (2), (3)) AS v(k) WHERE i + k - 1 <= size GROUP BY ALL
), totals AS (
  SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidate AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10
), parts AS MATERIALIZED (
  SELECT c.*, v.cut_at, array_to_string(w[1 : cut_at], ' ') AS head, array_to_string(w[cut_at + 1 : k], ' ') AS tail
  FROM candidate c, (VALUES (1), (2)) AS v(cut_at) WHERE cut_at < k
), sides AS MATERIALIZED (
  SELECT lang, phrase, c FROM f
  WHERE (lang, phrase) IN (SELECT (lang, head) FROM parts UNION SELECT (lang, tail) FROM parts)
), cut AS (
  SELECT p.*, l.c AS l, r.c AS r, (1000000::HUGEINT * p.c * p.c) // (l.c::HUGEINT * r.c) AS score
  FROM parts p JOIN sides l ON l.lang = p.lang AND l.phrase = p.head JOIN sides r ON r.lang = p.lang AND r.phrase = p.tail
), lowest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
), absorbed AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT b.lang, unnest([b.w[1] || ' ' || b.w[2], b.w[2] || ' ' || b.w[3]]) AS phrase, b.c AS longer
    FROM candidate b WHERE b.k = 3
  ) JOIN f USING (lang, phrase) WHERE 100 * longer >= 50 * c
), kept AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, c DESC, phrase) AS rank
  FROM lowest ANTI JOIN absorbed USING (lang, phrase)
)
SELECT lang, rank::BIGINT AS rank, phrase, c::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score,
  n_left::BIGINT AS n_left, n_right::BIGINT AS n_right
FROM kept JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": JACCARD,
    "op9_mixing": MIXING,
    "op11_license_scan": LICENSES,
    "op12_collocations": COLLOCATIONS,
}
