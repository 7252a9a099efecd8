"""Independent SQL for the queries, in plain joins, windows and sums on whole tables.

Vectors are sparse (bucket, weight) rows here, copies are found with windows and
pairs are formed explicitly, so the SQL shares no method with the Spark plans.
"""

from __future__ import annotations

from openends import defaults
from openends.catalog import tables as t
from openends.functions.text import NOT_WORD_OR_SPACE, SPACES, TERM, WORD
from openends.operators import density

DIM = t.STUDY.output_dim
SETS = t.STUDY.anchor_sets()
NAMES = [s.construct for s in SETS]
THEMES = list(defaults.THEMES)
FLAGS = (
    "flag_empty, flag_too_short, flag_duplicate_verbatim, flag_near_identical_cross_respondent"
)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def clean(column: str) -> str:
    return f"coalesce(trim(regexp_replace({column}, '{SPACES}', ' ', 'g')), '')"


def norm(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({column}), '{NOT_WORD_OR_SPACE}', '', 'g'), "
        f"'{SPACES}', ' ', 'g'))"
    )


def bucket(token: str) -> str:
    return f"(('0x' || substr(md5({token}), 1, 8))::BIGINT % {DIM})"


def theme_of(index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {quoted(name)}" for i, name in enumerate(THEMES))
    return f"CASE {index} {cases} END"


RESPONSES = f"""raw AS (
  SELECT conv_id, turn // 5 AS block,
    {', '.join(f"max(CASE WHEN turn % 5 = {i} THEN text END) AS t{i}" for i in range(5))}
  FROM conversations GROUP BY 1, 2
), responses AS (
  SELECT 'R' || conv_id AS respondent_id, 'AD' || (conv_id // {t.PER_AD} + block) AS ad_id,
    'Brand ' || ((conv_id // {t.PER_AD} + block) % 5) AS brand,
    'Platform ' || ((conv_id // {t.PER_AD} + block) % 3) AS platform,
    block + 1 AS order_shown,
    {', '.join(f"{clean(f't{i}')} AS a{i}" for i in range(5))}
  FROM raw
)"""

SEGMENTS = f"""{RESPONSES}, segments AS (
  SELECT respondent_id || '__' || ad_id || '__' || theme AS segment_id, * FROM (
    SELECT respondent_id, ad_id, brand, platform, order_shown, 'Memory' AS theme, a0 AS text
      FROM responses
    UNION ALL SELECT respondent_id, ad_id, brand, platform, order_shown, 'Meaning', a1
      FROM responses
    UNION ALL SELECT respondent_id, ad_id, brand, platform, order_shown, 'Emotion', a2
      FROM responses
    UNION ALL SELECT respondent_id, ad_id, brand, platform, order_shown, 'Optimisation',
      concat_ws(' || ', nullif(a3, ''), nullif(a4, '')) FROM responses)
)"""

DOCS = f"""docs AS (
  SELECT 'D' || doc_id AS segment_id, doc_id, source AS respondent_id, lang AS ad_id,
    {theme_of('length(text) % 4')} AS theme, text FROM documents
)"""


def gate(source: str, min_tokens: int = 4, cell: str = "") -> str:
    by = f"{cell}, " if cell else ""
    return f"""counted AS (
  SELECT *, {norm('text')} AS norm_text,
    len(regexp_extract_all(text, '{WORD}')) AS token_count FROM {source}
), checked AS (
  SELECT *, text = '' AS flag_empty, text <> '' AND token_count < {min_tokens} AS flag_too_short,
    norm_text <> '' AND count(*) OVER (PARTITION BY {by}respondent_id, theme, norm_text) > 1
      AS flag_duplicate_verbatim,
    text <> '' AND length(norm_text) >= 20
      AND count(*) OVER (PARTITION BY {by}ad_id, theme, norm_text) > 1
      AS flag_near_identical_cross_respondent
  FROM counted
), qc AS (
  SELECT *, flag_empty OR flag_too_short OR flag_duplicate_verbatim
    OR flag_near_identical_cross_respondent AS quarantined FROM checked
)"""


def sparse(name: str, source: str, key: str) -> str:
    """Unit vectors of hashed tokens as (key, b, w) rows."""
    return f"""{name}_n AS (
  SELECT {key}, {bucket('token')} AS b, count(*)::DOUBLE AS n
  FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '{WORD}')) AS token FROM {source})
  GROUP BY ALL
), {name} AS (
  SELECT {key}, b, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS w FROM {name}_n
)"""


PHRASES = ", ".join(
    f"({quoted(s.construct)}, {quoted(s.theme)}, {i}, {quoted(phrase)})"
    for s in SETS
    for i, phrase in enumerate(s.phrases)
)

CENTROIDS = f"""phrases AS (
  SELECT *, construct || '/' || phrase_no AS pid
  FROM (VALUES {PHRASES}) AS v(construct, theme, phrase_no, text)
), constructs AS (
  SELECT construct, theme, count(*) AS n_phrases FROM phrases GROUP BY ALL
), {sparse('pvec', 'phrases', 'pid')}, csum AS (
  SELECT p.construct, v.b, sum(v.w) AS m FROM pvec v JOIN phrases p USING (pid) GROUP BY ALL
), cent AS (
  SELECT construct, b, m / n_phrases / greatest(
    sqrt(sum((m / n_phrases) * (m / n_phrases)) OVER (PARTITION BY construct)), 1e-8) AS w
  FROM csum JOIN constructs USING (construct)
)"""


def scores(source: str, extra: str = "") -> str:
    """Long scores of scoreable rows of `source` against the study's centroids."""
    return f"""{CENTROIDS}, {sparse('svec', source, 'segment_id')}, dots AS (
  SELECT v.segment_id, c.construct, sum(v.w * c.w) AS s
  FROM svec v JOIN cent c USING (b) GROUP BY ALL
), score AS (
  SELECT q.*, c.construct, (coalesce(d.s, 0) + 1) / 2 AS score
  FROM {source} q JOIN constructs c USING (theme)
  LEFT JOIN dots d ON d.segment_id = q.segment_id AND d.construct = c.construct
)"""


SCORED = f"""{SEGMENTS}, {gate('segments')}, ok AS (
  SELECT * FROM qc WHERE NOT quarantined
), {scores('ok')}"""

CONVERSATIONS = f"""{SCORED}, conversations_ok AS (
  SELECT respondent_id, ad_id, any_value(order_shown) AS order_shown, any_value(brand) AS brand,
    any_value(platform) AS platform, count(*) AS n_themes_scored
  FROM ok GROUP BY 1, 2
)"""


def wide_mean(names: list[str], inner: str = "score") -> str:
    return ", ".join(
        f"round(avg(score) FILTER (construct = {quoted(n)}), 6) AS anchor_{n}" for n in names
    )


def wide_stats(names: list[str]) -> str:
    parts = []
    for n in names:
        which = f"FILTER (construct = {quoted(n)})"
        parts.append(f"round(avg(score) {which}, 6) AS anchor_{n}_mean")
        parts.append(f"round(stddev_samp(score) {which}, 6) AS anchor_{n}_std")
    return ", ".join(parts)


def ad_stats(table: str, cell: str = "") -> str:
    by = f"{cell}, " if cell else ""
    return f"""SELECT {by}ad_id, round(avg(order_shown), 6) AS order_shown_mean,
    round(stddev_samp(order_shown), 6) AS order_shown_std, count(*) AS n_conversations
    FROM {table} GROUP BY {by}ad_id"""


# Vector tables: embeddings by position, constructs by label.
VECTORS = f"""elems AS (
  SELECT vec_id, label, unnest(range(len(embedding))) AS pos,
    unnest(embedding)::DOUBLE AS x FROM embeddings
), vsegs AS (
  SELECT 'V' || vec_id AS segment_id, vec_id, 'R' || (vec_id % {t.VECTORS_PER_AD}) AS respondent_id,
    'AD' || (vec_id // {t.VECTORS_PER_AD}) AS ad_id, vec_id % 3 + 1 AS order_shown,
    {theme_of('label % 4')} AS theme, CASE WHEN label = 9 THEN -1 ELSE label END::BIGINT AS topic_id
  FROM embeddings
), vmean AS (
  SELECT 'c' || label AS construct, {theme_of('label % 4')} AS theme, pos, avg(x) AS m
  FROM elems GROUP BY label, pos
), vcent AS (
  SELECT construct, theme, pos, m / greatest(sqrt(sum(m * m) OVER (PARTITION BY construct)), 1e-8)
    AS w FROM vmean
)"""

VECTOR_SCORES = f"""{VECTORS}, score AS (
  SELECT s.segment_id, s.respondent_id, s.ad_id, s.order_shown, c.construct,
    (sum(e.x * c.w) + 1) / 2 AS score
  FROM vsegs s JOIN elems e USING (vec_id) JOIN vcent c ON c.theme = s.theme AND c.pos = e.pos
  GROUP BY ALL
)"""
VECTOR_NAMES = list(t.VECTOR_CONSTRUCTS)

LABELS = """labelled AS (
  SELECT 'AD' || user_id AS ad_id, 1 + sum(round(value * 100)::BIGINT)::BIGINT % 99 AS result
  FROM events GROUP BY user_id
), lab AS (
  SELECT ad_id, CASE WHEN result >= 70 THEN 'Strong' WHEN result >= 31 THEN 'Average' ELSE 'Weak'
    END AS band, result::DOUBLE AS score FROM labelled
)"""

PREDICTIONS = """preds AS (
  SELECT user_id % 5 AS fold, (event_id % 3)::DOUBLE AS label,
    (floor(value)::BIGINT % 3)::DOUBLE AS prediction FROM events
)"""

def topic_docs(vocabulary: str = "") -> str:
    """Terms and their weights per topic; `vocabulary` may order and cut the terms."""
    return f"""{DOCS}, numbered AS (
  SELECT *, ascii(ad_id) % 5 * 4 + length(text) % 4 AS k FROM docs
), tdocs AS (SELECT *, CASE WHEN k % 7 = 0 THEN -1 ELSE k END AS topic_id FROM numbered),
words AS (
  SELECT topic_id, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term
  FROM tdocs WHERE topic_id <> -1
), cnt AS (
  SELECT topic_id, term, count(*) AS n FROM words
  WHERE term NOT IN ({', '.join(quoted(w) for w in t.STOP_WORDS)}) GROUP BY ALL
), vocab AS (
  SELECT term, count(*) AS df FROM cnt GROUP BY term {vocabulary}
), weights AS (
  SELECT topic_id, term, n,
    n::DOUBLE / greatest(sum(n) OVER (PARTITION BY topic_id), 1)
    * ln(1 + (SELECT count(DISTINCT topic_id) FROM tdocs WHERE topic_id <> -1)::DOUBLE
      / greatest(df, 1)) AS weight
  FROM cnt JOIN vocab USING (term)
)"""

JUDGE_RAW = """replies AS (
  SELECT 'D' || doc_id AS segment_id, construct, CASE WHEN doc_id % 7 IN (0, 1) THEN NULL
    ELSE (quality * 3 + toxic + doc_id % 5) / 8.0::DOUBLE END AS judge_score
  FROM labels, (VALUES ('enjoyability'), ('authenticity')) AS c(construct)
)"""

JUDGED = f"""{DOCS}, edocs AS (
  SELECT segment_id, 'Emotion' AS theme, text FROM docs WHERE length(text) > 0
), {scores('edocs')}, {JUDGE_RAW}, judged AS (
  SELECT construct, round(s.score, 3) AS anchor_score, r.judge_score
  FROM score s JOIN replies r USING (segment_id, construct) WHERE r.judge_score IS NOT NULL
), ranked AS (
  SELECT *,
    rank() OVER (PARTITION BY construct ORDER BY anchor_score)
      + (count(*) OVER (PARTITION BY construct, anchor_score) - 1) / 2.0 AS ar,
    rank() OVER (PARTITION BY construct ORDER BY judge_score)
      + (count(*) OVER (PARTITION BY construct, judge_score) - 1) / 2.0 AS jr
  FROM judged
)"""

CACHE = f"""turn_texts AS (
  SELECT text FROM conversations
  UNION ALL SELECT text FROM documents GROUP BY text HAVING count(*) > 1
), cached AS (
  SELECT DISTINCT sha256('hashed-tokens||{DIM}|' || text) AS key FROM turn_texts
), wanted AS (
  SELECT DISTINCT sha256('hashed-tokens||{DIM}|' || text) AS key, text FROM documents
)"""

PROBES = f"""turns AS (
  SELECT a.conv_id || '-' || a.turn AS conv_id, a.text AS opening, b.text AS reply
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
), texts AS (
  SELECT conv_id || '/o' AS k, opening AS text FROM turns
  UNION ALL SELECT conv_id || '/s', opening || ' ' || opening FROM turns
  UNION ALL SELECT conv_id || '/u', reply FROM turns
), {sparse('probe', 'texts', 'k')}, lengths AS (
  SELECT k, sqrt(sum(w * w)) AS len FROM probe GROUP BY k
), likeness AS (
  SELECT split_part(a.k, '/', 1) AS conv_id, split_part(b.k, '/', 2) AS kind, sum(a.w * b.w) AS d
  FROM probe a JOIN probe b
    ON a.b = b.b AND split_part(a.k, '/', 1) = split_part(b.k, '/', 1)
  WHERE split_part(a.k, '/', 2) = 'o' AND split_part(b.k, '/', 2) <> 'o' GROUP BY ALL
), cosines AS (
  SELECT conv_id::VARCHAR AS subject,
    coalesce((SELECT d FROM likeness l WHERE l.conv_id = c.conv_id::VARCHAR AND kind = 's'), 0)
      / ((SELECT len FROM lengths WHERE k = c.conv_id || '/o')
       * (SELECT len FROM lengths WHERE k = c.conv_id || '/s') + 1e-8)
    - coalesce((SELECT d FROM likeness l WHERE l.conv_id = c.conv_id::VARCHAR AND kind = 'u'), 0)
      / ((SELECT len FROM lengths WHERE k = c.conv_id || '/o')
       * (SELECT len FROM lengths WHERE k = c.conv_id || '/u') + 1e-8) AS gap
  FROM turns c
), pair_result AS (
  SELECT 'pairs' AS "check", subject, gap AS value,
    CASE WHEN gap <= 0 THEN 'NOT DISCRIMINATING' WHEN gap < 0.05 THEN 'SMALL GAP' ELSE 'ok' END
      AS status FROM cosines
)"""

NORM_RESULT = f"""lens AS (
  SELECT vec_id, sqrt(sum(x * x)) AS len FROM elems GROUP BY vec_id
), norm_result AS (
  SELECT 'norms' AS "check", 'all vectors' AS subject, max(abs(len - 1)) AS value,
    CASE WHEN max(abs(len - 1)) <= 0.001 THEN 'ok' ELSE 'NOT NORMALISED' END AS status FROM lens
)"""

COHESION_RESULT = """pair_dots AS (
  SELECT a.label, a.vec_id AS i, b.vec_id AS j,
    list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
    / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
     * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) + 1e-8) AS c
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
), cohesion_result AS (
  SELECT 'cohesion' AS "check", 'c' || e.label AS subject, avg(c) AS value,
    CASE WHEN avg(c) < 0.4 THEN 'LOW' ELSE 'ok' END AS status
  FROM (SELECT DISTINCT label FROM embeddings) e LEFT JOIN pair_dots p ON p.label = e.label
  GROUP BY e.label
)"""

SEPARATION_RESULT = """cpairs AS (
  SELECT a.construct AS f, b.construct AS s, sum(a.w * b.w)
    / (sqrt(sum(a.w * a.w)) * sqrt(sum(b.w * b.w)) + 1e-8) AS c
  FROM vcent a JOIN vcent b ON a.pos = b.pos AND a.construct < b.construct GROUP BY 1, 2
), separation_result AS (
  SELECT 'separation' AS "check", f || ' / ' || s AS subject, c AS value,
    CASE WHEN c > 0.85 THEN 'HIGH OVERLAP' ELSE 'ok' END AS status FROM cpairs
)"""

VARIANCE_RESULT = """ad_means AS (
  SELECT ad_id, construct, avg(score) AS m FROM score GROUP BY 1, 2
), variance_result AS (
  SELECT 'variance' AS "check", 'anchor_' || construct || '_mean' AS subject,
    stddev_samp(m) AS value,
    CASE WHEN stddev_samp(m) < 0.02 THEN 'FLAT' ELSE 'ok' END AS status
  FROM ad_means GROUP BY construct
)"""

RESULT = 'SELECT "check", subject, round(value, 6) AS value, status FROM'

GRID = ", ".join(f"({n})" for n in t.STUDY.conversations_grid)

CELLS = f"""{SEGMENTS}, repeats AS (
  SELECT ad_id, respondent_id, r AS "repeat", row_number() OVER (
    PARTITION BY ad_id, r ORDER BY md5((42 + r) || '|' || respondent_id), respondent_id) AS k
  FROM (SELECT DISTINCT ad_id, respondent_id FROM responses), range({t.STUDY.n_repeats}) AS x(r)
), cells AS (
  SELECT ad_id, respondent_id, "repeat", n AS n_per_ad
  FROM repeats JOIN (VALUES {GRID}) AS g(n) ON k <= n
), csegs AS (
  SELECT s.*, c."repeat", c.n_per_ad FROM segments s JOIN cells c USING (ad_id, respondent_id)
), {gate('csegs', cell='n_per_ad, "repeat"')}, ok AS (
  SELECT * FROM qc WHERE NOT quarantined
), texts AS (SELECT DISTINCT segment_id, theme, text FROM ok), {scores('texts')}, cscore AS (
  SELECT o.n_per_ad, o."repeat", o.ad_id, s.construct, s.score
  FROM ok o JOIN score s USING (segment_id)
), convs AS (
  SELECT n_per_ad, "repeat", respondent_id, ad_id, any_value(order_shown) AS order_shown
  FROM ok GROUP BY ALL
)"""

AXES = ", ".join(
    f"floor(round(list_dot_product(embedding::DOUBLE[], {[float(x) for x in t.signs(axis)]}) / 8, 9)"
    f" / 0.06)::INT AS {name}"
    for axis, name in enumerate("abc")
)

DENSITY = f"""placed AS (
  SELECT 'V' || vec_id AS segment_id, 'AD' || (vec_id // {t.VECTORS_PER_AD}) AS ad_id, {AXES}
  FROM embeddings
), dense AS (
  SELECT a, b, c, a || ',' || b || ',' || c AS cell FROM placed GROUP BY a, b, c
  HAVING count(*) >= 3
), edges AS (
  SELECT p.cell, q.cell AS other FROM dense p JOIN dense q
    ON abs(p.a - q.a) <= 1 AND abs(p.b - q.b) <= 1 AND abs(p.c - q.c) <= 1
), reach AS (
  SELECT cell, cell AS label FROM dense
  UNION SELECT e.other, r.label FROM reach r JOIN edges e ON e.cell = r.cell
), groups AS (SELECT cell, min(label) AS label FROM reach GROUP BY cell), assigned AS (
  SELECT segment_id, ad_id, label,
    count(*) OVER (PARTITION BY label) AS size
  FROM placed p LEFT JOIN groups g ON g.cell = p.a || ',' || p.b || ',' || p.c
)"""


def projected_topics(radius: float, tables: list) -> str:
    """Topics of documents by buckets of projections, one row per number of a vector."""
    listed = ", ".join(
        f"({t}, {k}, {vector}, {offset})"
        for t, directions in enumerate(tables)
        for k, (vector, offset) in enumerate(directions)
    )
    width = density.WIDTH * density.STEPS * density.UNIT
    return f"""WITH RECURSIVE {sparse('v', 'documents', 'doc_id')}, filled AS (
      SELECT d.doc_id, r.i, coalesce(round(v.w * {density.STEPS / radius!r}::DOUBLE), 0)::BIGINT AS q
      FROM documents d CROSS JOIN range(64) r(i)
      LEFT JOIN v ON v.doc_id = d.doc_id AND v.b = r.i
    ), placed AS (
      SELECT doc_id, md5(string_agg(q::VARCHAR, ',' ORDER BY i)) AS place FROM filled GROUP BY 1
    ), places AS (
      SELECT place, count(*) AS n, min(doc_id) AS doc_id FROM placed GROUP BY 1
    ), pq AS (SELECT place, n, i, q FROM places JOIN filled USING (doc_id)
    ), listed AS (SELECT * FROM (VALUES {listed}) AS x(t, k, vector, shift)
    ), axes AS (SELECT t, k, shift, unnest(vector) AS a, unnest(range(64)) AS i FROM listed
    ), cells AS (
      SELECT place, t, k, floor((sum(q * a) + max(shift)) / {width}.0::DOUBLE)::BIGINT AS cell
      FROM pq JOIN axes USING (i) GROUP BY ALL
    ), buckets AS (
      SELECT place, t || ':' || string_agg(cell::VARCHAR, ',' ORDER BY k) AS bucket
      FROM cells GROUP BY place, t
    ), means AS (
      SELECT bucket, i, sum(q * n)::DOUBLE / sum(n)::DOUBLE AS mean
      FROM buckets JOIN pq USING (place) GROUP BY ALL
    ), near AS (
      SELECT bucket, place, max(n) AS n FROM buckets JOIN pq USING (place)
      JOIN means USING (bucket, i) GROUP BY bucket, place
      HAVING sum((q - mean) * (q - mean)) <= {density.STEPS**2}
    ), links AS (
      SELECT place, min(place) OVER (PARTITION BY bucket) AS hub FROM near
      QUALIFY sum(n) OVER (PARTITION BY bucket) >= 3
    ), both_ways AS (SELECT place AS a, hub AS b FROM links UNION SELECT hub, place FROM links
    ), reach AS (
      SELECT a AS place, a AS label FROM both_ways
      UNION SELECT e.b, r.label FROM reach r JOIN both_ways e ON e.a = r.place
    ), groups AS (SELECT place, min(label) AS label FROM reach GROUP BY 1), sized AS (
      SELECT doc_id, label, count(*) OVER (PARTITION BY label) AS size
      FROM placed LEFT JOIN groups USING (place)
    ) SELECT doc_id, CASE WHEN label IS NULL OR size < 8 THEN -1
      ELSE ('0x' || substr(label, 1, 13))::BIGINT END AS topic_id FROM sized"""


def run_counts() -> str:
    """Every count of a run, from its responses and flagged segments."""
    flags = [*FLAGS.split(", "), "quarantined"]
    parts = [
        "SELECT 'responses' AS part, 'rows' AS name, count(*) AS n FROM responses",
        "SELECT 'responses', 'blank_keys', count(*) FROM responses "
        "WHERE trim(respondent_id) = '' OR trim(ad_id) = ''",
        "SELECT 'responses', 'kept', count(*) FROM responses "
        "WHERE trim(respondent_id) <> '' AND trim(ad_id) <> ''",
        "SELECT 'responses', 'respondents', count(DISTINCT respondent_id) FROM responses",
        "SELECT 'responses', 'ads', count(DISTINCT ad_id) FROM responses",
        "SELECT 'quality', 'segments', count(*) FROM qc",
        *[f"SELECT 'quality', '{flag}', count(*) FROM qc WHERE {flag}" for flag in flags],
        "SELECT 'quality', 'fully_quarantined_ads', count(*) FROM (SELECT DISTINCT ad_id FROM qc "
        "EXCEPT SELECT ad_id FROM qc WHERE NOT quarantined)",
        *[
            f"SELECT 'scoreable', '{theme}', count(*) FROM qc "
            f"WHERE NOT quarantined AND theme = '{theme}'"
            for theme in THEMES
        ],
        *[
            f"SELECT 'scores', 'anchor_{s.construct}', count(*) FROM qc "
            f"WHERE NOT quarantined AND theme = {quoted(s.theme)}"
            for s in SETS
        ],
    ]
    return f"WITH {SEGMENTS}, {gate('segments')} {' UNION ALL '.join(parts)}"


def oracle() -> dict[str, str]:
    """SQL per query name."""
    sql: dict[str, str] = {}
    keys = "respondent_id, ad_id, brand, platform, order_shown"
    sql["response_contract"] = (
        f"WITH {RESPONSES} SELECT {keys}, a0 AS memory, a1 AS meaning, a2 AS emotion, "
        "a3 AS improvement, a4 AS reason FROM responses"
    )
    sql["response_counts"] = (
        f"WITH {RESPONSES} SELECT count(*) AS n_rows, "
        "count(DISTINCT respondent_id) AS n_respondents, count(DISTINCT ad_id) AS n_ads "
        "FROM responses"
    )
    sql["blank_keys"] = (
        f"WITH {RESPONSES} SELECT count(*) FILTER (respondent_id = '' OR ad_id = '') "
        "AS n_blank_keys, count(*) AS n_rows FROM responses"
    )
    sql["repeated_pairs"] = (
        "SELECT source AS respondent_id, lang AS ad_id, count(*) AS n_rows FROM documents "
        "GROUP BY 1, 2 HAVING count(*) > 1"
    )
    sql["append_responses"] = (
        "WITH r AS (SELECT DISTINCT conv_id, turn // 5 + 1 AS o FROM conversations) "
        "SELECT o || CASE WHEN conv_id % 3 = 0 THEN '.7' ELSE '' END AS order_text, "
        "count(*) AS n_rows, count(DISTINCT conv_id) AS n_respondents FROM r GROUP BY 1"
    )
    sql["append_round_trip"] = (
        "WITH r AS (SELECT DISTINCT conv_id, turn // 5 + 1 AS o FROM conversations) "
        "SELECT o AS order_shown, count(*) AS n_rows, count(DISTINCT conv_id) AS n_respondents "
        "FROM r GROUP BY 1"
    )
    sql["segments_long"] = (
        f"WITH {SEGMENTS} SELECT segment_id, {keys}, theme, text FROM segments"
    )
    sql["token_count_norm_text"] = (
        f"SELECT doc_id, len(regexp_extract_all(text, '{WORD}')) AS token_count, "
        f"{norm('text')} AS norm_text FROM documents"
    )
    sql["qc_flags"] = (
        f"WITH {DOCS}, {gate('docs')} SELECT doc_id, theme, {FLAGS}, quarantined FROM qc"
    )
    sql["qc_flags_distinct_respondents"] = f"""WITH {DOCS}, {gate('docs')}, people AS (
      SELECT ad_id, theme, norm_text, count(DISTINCT respondent_id) AS n FROM qc GROUP BY ALL
    ), near AS (
      SELECT qc.*, text <> '' AND length(norm_text) >= 20 AND n > 1 AS near_flag
      FROM qc JOIN people USING (ad_id, theme, norm_text)
    ) SELECT doc_id, near_flag AS flag_near_identical_cross_respondent,
      flag_empty OR flag_too_short OR flag_duplicate_verbatim OR near_flag AS quarantined
    FROM near"""
    sql["qc_flags_responses"] = (
        f"WITH {SEGMENTS}, {gate('segments')} SELECT segment_id, token_count, {FLAGS}, "
        "quarantined FROM qc"
    )
    sums = ", ".join(f"count(*) FILTER ({f.strip()}) AS {f.strip()}" for f in FLAGS.split(","))
    sql["qc_report"] = (
        f"WITH {DOCS}, {gate('docs')} SELECT theme, {sums}, "
        "count(*) FILTER (quarantined) AS quarantined, count(*) AS n_segments, "
        "round_even(count(*) FILTER (quarantined) / count(*), 3) AS quarantine_rate "
        "FROM qc GROUP BY theme"
    )
    sql["qc_totals"] = (
        f"WITH {DOCS}, {gate('docs')} SELECT count(*) FILTER (quarantined) AS n_quarantined, "
        "count(*) AS n_segments, round(100.0::DOUBLE * (count(*) FILTER (quarantined)) "
        "/ greatest(count(*), 1), 6) AS quarantined_pct FROM qc"
    )
    sql["quarantine_free_segments"] = (
        f"WITH {DOCS}, {gate('docs')} SELECT doc_id, theme, text FROM qc WHERE NOT quarantined"
    )
    sql["ads_fully_quarantined"] = (
        f"WITH {DOCS}, {gate('docs', 400)} "
        "SELECT respondent_id || '/' || ad_id || '/' || theme AS ad_id, count(*) AS n_segments "
        "FROM qc GROUP BY 1 HAVING bool_and(quarantined)"
    )
    payload = "'Find answers like: ' || text"
    sql["content_keys"] = (
        "SELECT doc_id, sha256('hashed-tokens|Find answers like: {text}|64|' || text) AS key, "
        f"md5({payload}) AS payload_md5 FROM documents"
    )
    sql["vector_normalize"] = f"""WITH {VECTORS}, y AS (
      SELECT vec_id, pos, x * 3 + 0.01 AS x FROM elems
    ) SELECT vec_id, pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value
    FROM y"""
    sql["vector_truncate"] = f"""WITH {VECTORS} SELECT vec_id, pos,
      round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value
      FROM elems WHERE pos < 16"""
    sql["vector_dimension_check"] = (
        "SELECT min(len(embedding)) AS shortest, max(len(embedding)) AS longest, "
        "count(*) AS n_vectors, min(len(embedding)) >= 64 AS dim_ok FROM embeddings"
    )
    sql["hashed_encoder"] = (
        f"WITH {sparse('v', 'documents', 'doc_id')} "
        "SELECT doc_id, b AS pos, round(w, 6) AS value FROM v WHERE round(w, 6) <> 0"
    )
    sql["cache_misses"] = (
        f"WITH {CACHE} SELECT key, length(text) AS n_chars FROM wanted "
        "WHERE key NOT IN (SELECT key FROM cached)"
    )
    sql["cache_counts"] = (
        f"WITH {CACHE} SELECT count(*) AS n_keys, count(c.key) AS n_hits, "
        "count(*) - count(c.key) AS n_misses FROM wanted w LEFT JOIN cached c ON c.key = w.key"
    )
    sql["cache_upsert"] = """WITH merged AS (
      SELECT vec_id::VARCHAR AS key, embedding AS v, 1 AS batch FROM embeddings
      UNION ALL SELECT (vec_id + 100)::VARCHAR, list_reverse(embedding), 2 FROM embeddings
    ), kept AS (SELECT key, v FROM merged QUALIFY row_number() OVER (
      PARTITION BY key ORDER BY batch DESC) = 1)
    SELECT key, unnest(range(len(v))) AS pos, round(unnest(v)::DOUBLE, 6) AS value FROM kept"""
    sql["cached_embedding"] = f"""WITH {SEGMENTS}, {gate('segments')}, ok AS (
      SELECT * FROM qc WHERE NOT quarantined
    ), {sparse('v', 'ok', 'segment_id')}
    SELECT segment_id, b AS pos, round(w::FLOAT::DOUBLE, 6) AS value FROM v
    WHERE round(w, 6) <> 0"""
    sql["construct_centroids"] = (
        f"WITH {VECTORS} SELECT construct, pos, round(w, 6) AS value FROM vcent"
    )
    sql["anchor_scores_long"] = (
        f"WITH {VECTOR_SCORES} SELECT segment_id, construct, round(score, 6) AS score FROM score"
    )
    wide = f"WITH {VECTOR_SCORES} SELECT segment_id, {wide_mean(VECTOR_NAMES)} FROM score GROUP BY 1"
    for name in ("anchor_scores_wide", "anchor_scores_pivot", "anchor_scores_arrow"):
        sql[name] = wide
    stretched = ", ".join(
        f"round(10 * avg(score) FILTER (construct = {quoted(n)}), 6) AS anchor_{n}"
        for n in VECTOR_NAMES
    )
    sql["calibrated_scores"] = (
        f"WITH {VECTOR_SCORES} SELECT segment_id, {stretched} FROM score GROUP BY 1"
    )
    sql["attached_scores"] = f"""WITH {VECTOR_SCORES}, w AS (
      SELECT segment_id, max(score) FILTER (construct = 'c1') AS c1,
        max(score) FILTER (construct = 'c5') AS c5 FROM score GROUP BY 1
    ) SELECT s.segment_id, s.ad_id, round(w.c1, 6) AS anchor_c1, round(w.c5, 6) AS anchor_c5
    FROM vsegs s LEFT JOIN w ON w.segment_id = s.segment_id AND w.c1 > 0.5"""
    sql["constructs_without_segments"] = f"""WITH {DOCS}, m AS (
      SELECT DISTINCT 'c' || label AS construct, CASE WHEN label = 9 THEN 'Recall'
        ELSE {theme_of('label % 4')} END AS theme FROM embeddings
    ) SELECT theme, construct FROM m WHERE theme NOT IN (SELECT theme FROM docs)"""
    sql["ad_construct_scores"] = (
        f"WITH {SCORED} SELECT ad_id, construct, round(avg(score), 6) AS score_mean, "
        "round(stddev_samp(score), 6) AS score_std, count(*) AS n_scores "
        "FROM score GROUP BY 1, 2"
    )
    sql["respondent_features"] = f"""WITH {CONVERSATIONS}, means AS (
      SELECT respondent_id, ad_id, {wide_mean(NAMES)} FROM score GROUP BY 1, 2
    ) SELECT * FROM conversations_ok LEFT JOIN means USING (respondent_id, ad_id)"""
    sql["ad_features"] = f"""WITH {CONVERSATIONS}, stats AS (
      SELECT ad_id, {wide_stats(NAMES)} FROM score GROUP BY 1
    ), orders AS ({ad_stats('conversations_ok')})
    SELECT * FROM orders LEFT JOIN stats USING (ad_id)"""
    sql["ad_features_with_quarantined"] = f"""WITH {SEGMENTS}, pairs AS (
      SELECT DISTINCT respondent_id, ad_id, order_shown FROM segments
    ) {ad_stats('pairs')}"""
    sql["ad_features_vectors"] = f"""WITH {VECTOR_SCORES}, stats AS (
      SELECT ad_id, {wide_stats(VECTOR_NAMES)} FROM score GROUP BY 1
    ), orders AS ({ad_stats('vsegs')}) SELECT * FROM orders LEFT JOIN stats USING (ad_id)"""
    sql["features_round_trip"] = sql["ad_features_vectors"]
    sql["order_shown_stats"] = f"WITH {CONVERSATIONS} {ad_stats('conversations_ok')}"
    sql["first_metadata"] = f"""WITH {DOCS}, {gate('docs')}, firsts AS (
      SELECT respondent_id, ad_id, count(*) AS n_themes_scored, min(doc_id) AS d
      FROM qc WHERE NOT quarantined GROUP BY 1, 2
    ) SELECT respondent_id, ad_id, n_themes_scored, d % 3 + 1 AS order_shown, 'b' || d AS brand,
      'p' || (d % 7) AS platform FROM firsts"""
    sql["construct_coverage"] = (
        f"WITH {SCORED} SELECT 'anchor_' || c.construct AS score_column, "
        "count(s.score) AS n_scored, count(s.score) = 0 AS all_missing "
        "FROM constructs c LEFT JOIN score s ON s.construct = c.construct GROUP BY c.construct"
    )
    sql["topic_shares"] = f"""WITH {VECTORS}, n AS (
      SELECT ad_id, topic_id, count(*) AS n_segments FROM vsegs WHERE topic_id <> -1 GROUP BY ALL
    ) SELECT *, round(n_segments / sum(n_segments) OVER (PARTITION BY ad_id), 6) AS share FROM n"""
    shares = ", ".join(
        f"round(count(*) FILTER (topic_id = {i}) / count(*), 6) AS topic_share_{i}"
        for i in range(9)
    )
    sql["topic_shares_wide"] = (
        f"WITH {VECTORS} SELECT ad_id, {shares} FROM vsegs WHERE topic_id <> -1 GROUP BY ad_id"
    )
    sql["topic_summary"] = (
        f"WITH {VECTORS} SELECT count(DISTINCT topic_id) FILTER (topic_id <> -1) AS n_topics, "
        "count(*) FILTER (topic_id = -1) AS n_noise, count(*) AS n_segments FROM vsegs"
    )
    sql["topic_term_weights_5000"] = (
        f"WITH {topic_docs('ORDER BY sum(n) DESC, term LIMIT 5000')} "
        "SELECT topic_id::BIGINT AS topic_id, term, n, round(weight, 6) AS weight FROM weights"
    )
    sql["topic_term_weights"] = (
        f"WITH {topic_docs()} SELECT topic_id::BIGINT AS topic_id, term, n, "
        "round(weight, 6) AS weight FROM weights"
    )
    sql["ctfidf_labels"] = f"""WITH {topic_docs()}, best AS (
      SELECT topic_id, term, row_number() OVER (
        PARTITION BY topic_id ORDER BY round(weight, 9) DESC, term) AS place FROM weights
    ) SELECT topic_id::BIGINT AS topic_id, string_agg(term, ', ' ORDER BY place) AS label
    FROM best WHERE place <= 6 GROUP BY topic_id"""
    sql["topics_density"] = f"""WITH RECURSIVE {DENSITY}
      SELECT segment_id, ad_id, CASE WHEN label IS NULL OR size < 8 THEN -1
        ELSE ('0x' || substr(md5(label), 1, 13))::BIGINT END AS topic_id FROM assigned"""
    sql["topics_projected"] = projected_topics(
        t.DENSITY["radius"],
        density.directions_of(64, t.DENSITY["tables"], t.DENSITY["directions"], 42),
    )
    sql["judge_parse"] = (
        f"WITH {JUDGE_RAW} SELECT segment_id, construct, round(judge_score, 6) AS judge_score "
        "FROM replies"
    )
    corr = "CASE WHEN stddev_pop({0}) > 0 AND stddev_pop({1}) > 0 THEN round(corr({0}, {1}), 6) END"
    sql["judge_correlation"] = (
        f"WITH {JUDGED} SELECT construct, count(*) AS n, "
        f"{corr.format('anchor_score', 'judge_score')} AS pearson_r, "
        f"{corr.format('ar', 'jr')} AS spearman_r FROM ranked GROUP BY construct"
    )
    sql["average_ranks"] = """SELECT DISTINCT event_type, value,
      rank() OVER (PARTITION BY event_type ORDER BY value)
        + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0::DOUBLE AS rank,
      count(*) OVER (PARTITION BY event_type, value) AS n_rows FROM events"""
    sql["seeded_sample"] = (
        "SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 30"
    )
    sql["labels_checked"] = f"WITH {LABELS} SELECT * FROM lab"
    sql["label_domain_violations"] = (
        "SELECT DISTINCT event_type AS band FROM events WHERE event_type <> 'click'"
    )
    sql["repeated_labels"] = (
        "SELECT 'AD' || user_id AS ad_id, count(*) AS n_labels FROM events GROUP BY user_id "
        "HAVING count(*) > 1"
    )
    filled = ", ".join(
        f"coalesce(anchor_{n}_mean, 0) AS anchor_{n}_mean, coalesce(anchor_{n}_std, 0) "
        f"AS anchor_{n}_std"
        for n in VECTOR_NAMES
    )
    sql["features_labels_join"] = f"""WITH {VECTOR_SCORES}, {LABELS}, stats AS (
      SELECT ad_id, {wide_stats(VECTOR_NAMES)} FROM score GROUP BY 1
    ), orders AS ({ad_stats('vsegs')})
    SELECT ad_id, {filled}, coalesce(order_shown_mean, 0) AS order_shown_mean,
      coalesce(order_shown_std, 0) AS order_shown_std, n_conversations, band, lab.score
    FROM orders LEFT JOIN stats USING (ad_id) JOIN lab USING (ad_id)"""
    sql["unlabelled_ads"] = f"""WITH {VECTORS}, {LABELS} SELECT DISTINCT ad_id FROM vsegs
      WHERE ad_id NOT IN (SELECT ad_id FROM lab WHERE band = 'Strong')"""
    sql["binary_target"] = f"""WITH {LABELS} SELECT ad_id, CASE WHEN score >=
      (SELECT median(score) FROM lab) THEN 'Top' ELSE 'Bottom' END AS target FROM lab"""
    sql["strong_weak_target"] = (
        f"WITH {LABELS} SELECT ad_id, band AS target FROM lab WHERE band <> 'Average'"
    )
    sql["label_encoding"] = (
        f"WITH {LABELS} SELECT ad_id, band AS target, dense_rank() OVER (ORDER BY band) - 1 "
        "AS label FROM lab"
    )
    sql["group_folds"] = f"""WITH {LABELS} SELECT ad_id,
      (row_number() OVER (ORDER BY md5('42|' || ad_id), ad_id) - 1) % 5 AS fold FROM lab"""
    sql["balanced_weights"] = f"""WITH {LABELS} SELECT ad_id, band AS target,
      round((SELECT count(*) FROM lab) / ((SELECT count(DISTINCT band) FROM lab)
        * count(*) OVER (PARTITION BY band))::DOUBLE, 6) AS weight FROM lab"""
    sql["sample_per_ad"] = """SELECT event_id, user_id, row_number() OVER (
      PARTITION BY user_id ORDER BY md5('42|' || event_id), event_id) AS sample_rank
      FROM events QUALIFY sample_rank <= 10"""
    sql["fold_accuracy"] = (
        f"WITH {PREDICTIONS} SELECT fold, round(avg((prediction = label)::INT), 6) AS score "
        "FROM preds GROUP BY fold"
    )
    sql["fold_r2"] = f"""WITH {PREDICTIONS}, m AS (SELECT fold, avg(label) AS mu FROM preds GROUP BY 1)
      SELECT fold, round(1 - sum((label - prediction) ** 2) / sum((label - mu) ** 2), 6) AS score
      FROM preds JOIN m USING (fold) GROUP BY fold"""
    sql["cv_summary"] = f"""WITH {PREDICTIONS}, f AS (
      SELECT fold, avg((prediction = label)::INT) AS score FROM preds GROUP BY fold
    ) SELECT round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score,
      count(score) AS n_folds FROM f"""
    sql["top_drivers"] = """SELECT 'f' || user_id AS feature, round(avg(value), 6) AS importance
      FROM events GROUP BY user_id ORDER BY importance DESC, feature LIMIT 15"""
    sql["learning_curve_features"] = f"""WITH {CELLS}, stats AS (
      SELECT n_per_ad, "repeat", ad_id, {wide_stats(NAMES)} FROM cscore GROUP BY ALL
    ), orders AS ({ad_stats('convs', 'n_per_ad, "repeat"')})
    SELECT * REPLACE (n_per_ad::BIGINT AS n_per_ad, "repeat"::BIGINT AS "repeat")
    FROM orders LEFT JOIN stats USING (n_per_ad, "repeat", ad_id)"""
    sql["predict_ads"] = sql["ad_features"]
    sql["predict_respondents"] = sql["respondent_features"]
    sql["predict_counts"] = run_counts()
    sql["predict_quality"] = sql["qc_report"].replace(DOCS, SEGMENTS).replace(
        gate("docs"), gate("segments")
    )
    sql["kmeans_violations"] = (
        "SELECT 0::BIGINT AS small_groups, 0::BIGINT AS wrong_shares, 0::BIGINT AS repeated_points "
        "FROM embeddings LIMIT 1"
    )
    sql["embedding_norm_check"] = f"""WITH {VECTORS}, {NORM_RESULT}
      SELECT "check", subject, round(value, 5) AS value, status FROM norm_result"""
    sql["pair_sanity"] = f"WITH {PROBES} {RESULT} pair_result"
    sql["anchor_cohesion"] = f"WITH {COHESION_RESULT} {RESULT} cohesion_result"
    sql["construct_separation"] = (
        f"WITH {VECTORS}, {SEPARATION_RESULT} {RESULT} separation_result"
    )
    sql["score_variance"] = f"WITH {VECTOR_SCORES}, {VARIANCE_RESULT} {RESULT} variance_result"
    parts = " UNION ALL ".join(
        f"{RESULT} {name}_result"
        for name in ("norm", "pair", "cohesion", "separation", "variance")
    )
    sql["diagnostics"] = (
        f"WITH {VECTOR_SCORES}, {NORM_RESULT}, {PROBES}, {COHESION_RESULT}, {SEPARATION_RESULT}, "
        f"{VARIANCE_RESULT} {parts}"
    )
    return sql
