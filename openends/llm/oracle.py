"""SQL (DuckDB) for the text operators that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = f"""
WITH plain AS (
  SELECT doc_id, {LOWER} AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(t) AS text_sha256
FROM plain WINDOW g AS (PARTITION BY t)
"""

OP4 = r"""
WITH RECURSIVE messages AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS t
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), split AS (
  SELECT conv_id, turn, regexp_split_to_array(t, '\r\n|\r|\n') AS l FROM messages
), raw AS (
  SELECT conv_id, turn, unnest(range(len(l))) AS line, unnest(l) AS raw FROM split
), marked AS (
  SELECT *, regexp_extract(raw, '^((?:[ \t]*>)+)', 1) AS marks FROM raw
), parsed AS (
  SELECT conv_id, turn, line, length(replace(replace(marks, ' ', ''), chr(9), '')) AS own_level,
    trim(substr(raw, length(marks) + 1)) AS content FROM marked
), levelled AS (
  SELECT *, CASE WHEN own_level = 0 AND lead(own_level) OVER w > 0 AND regexp_matches(content,
      '(?i)^\s*.{0,200}\b(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$')
    THEN -1 ELSE own_level END AS level
  FROM parsed WINDOW w AS (PARTITION BY conv_id, turn ORDER BY line)
), begun AS (
  SELECT *, CASE WHEN coalesce(lag(level) OVER w <> level, true) OR (content = '' AND level = 0)
    THEN 1 ELSE 0 END AS begins
  FROM levelled WINDOW w AS (PARTITION BY conv_id, turn ORDER BY line)
), lines AS (
  SELECT *, sum(begins) OVER (PARTITION BY conv_id, turn ORDER BY line) AS run FROM begun
), runs AS (
  SELECT conv_id, turn, run, level, string_agg(content, chr(10) ORDER BY line) AS content
  FROM lines GROUP BY ALL
), texts AS (
  SELECT conv_id, turn, run, level, content, 'run' AS kind FROM runs
  UNION ALL SELECT conv_id, turn, run, level, content, 'line' FROM lines WHERE level >= 0
  UNION ALL SELECT conv_id, turn, 0, 0, string_agg(content, chr(10) ORDER BY line), 'whole'
    FROM lines WHERE level = 0 GROUP BY 1, 2
), normal AS (
  SELECT *, trim(regexp_replace(lower(content), '\s+', ' ', 'g')) AS key FROM texts
), firsts AS (
  SELECT conv_id, key, min(turn) AS original FROM normal WHERE level = 0 AND key <> '' GROUP BY 1, 2
), votes AS (
  SELECT n.conv_id, n.turn, n.run, f.original, sum(length(n.key)) AS votes
  FROM normal n JOIN firsts f USING (conv_id, key)
  WHERE n.level > 0 AND n.key <> '' AND f.original < n.turn GROUP BY ALL
), best AS (
  SELECT conv_id, turn, run, original FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn, run ORDER BY votes DESC, original DESC) = 1
), quoted AS (
  SELECT n.conv_id, n.turn, n.run, n.level, length(n.key) AS size, b.original
  FROM normal n LEFT JOIN best b USING (conv_id, turn, run)
  WHERE n.kind = 'run' AND n.level > 0 AND n.key <> ''
), per_message AS (
  SELECT conv_id, turn, count(*) AS n_passages, max(level) AS max_level,
    count(original) AS n_linked,
    arg_max(original, (-level, size, original)) FILTER (original IS NOT NULL) AS quoted
  FROM quoted GROUP BY 1, 2
), own AS (
  SELECT conv_id, turn, regexp_replace(regexp_replace(string_agg(content, chr(10) ORDER BY line),
    '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text
  FROM lines WHERE level = 0 GROUP BY 1, 2
), replies AS (
  SELECT m.conv_id, m.turn, m.role, coalesce(o.text, '') AS text,
    coalesce(q.n_passages, 0) AS n_passages, coalesce(q.max_level, 0)::INT AS max_level,
    coalesce(q.n_linked, 0) AS n_linked, coalesce(q.quoted, e.turn) AS reply_to
  FROM messages m LEFT JOIN own o USING (conv_id, turn)
  LEFT JOIN per_message q USING (conv_id, turn)
  LEFT JOIN messages e ON e.conv_id = m.conv_id AND e.turn = m.turn - 1
), placed AS (
  SELECT conv_id, turn, turn AS thread, 0::BIGINT AS depth FROM replies WHERE reply_to IS NULL
  UNION ALL SELECT r.conv_id, r.turn, p.thread, p.depth + 1
  FROM placed p JOIN replies r ON r.conv_id = p.conv_id AND r.reply_to = p.turn
)
SELECT * FROM replies JOIN placed USING (conv_id, turn)
"""

OP11 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^ \x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
  FROM split WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), texts AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) AS same FROM split WHERE len(w) > 0
), one AS (
  SELECT s.* FROM shingles s JOIN texts t ON s.doc_id = t.doc_id WHERE t.same = t.doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM one x JOIN one y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
), reached AS (
  SELECT a AS doc_id, a AS other FROM (SELECT DISTINCT a FROM links)
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), lowest AS (
  SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(component, same, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN texts ON texts.doc_id = d.doc_id
  LEFT JOIN lowest ON lowest.doc_id = same
"""

OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(p, '[^ \x09]+') AS w FROM pieces
), found AS (
  SELECT lang, unnest(list_concat(
    list_transform(range(1, len(w) + 1), lambda i: w[i:i]),
    list_transform(range(1, len(w)), lambda i: w[i:i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]))) AS p
  FROM split
), f AS (
  SELECT lang, p, count(*)::HUGEINT AS f FROM found GROUP BY lang, p
), total AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang
), candidates AS (
  SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, 1000000 * c.a * c.a // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest x WHERE NOT EXISTS (
    SELECT 1 FROM candidates y WHERE y.lang = x.lang AND len(y.p) = 3 AND len(x.p) = 2
      AND (y.p[1:2] = x.p OR y.p[2:3] = x.p) AND 100 * y.a >= 50 * x.a)
), ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP13 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
  s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLE: dict[str, str] = {
    "op4_quotes": OP4,
    "op7_exact_dedup": OP7,
    "op11_jaccard_join": OP11,
    "op12_phrases": OP12,
    "op13_hard_negatives": OP13,
}
