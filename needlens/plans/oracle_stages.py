"""DuckDB SQL of the composed stages in ``checked``."""

from __future__ import annotations


def _keywords(p: str, rows: str, stop: str) -> str:
    """``{p}kw(cluster, keywords)`` by c-TF-IDF over ``rows(cluster, text)``."""
    return f"""
{p}k AS (SELECT count(DISTINCT cluster) AS k FROM {rows}),
{p}tok AS (
  SELECT cluster, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {rows}
),
{p}tf AS (SELECT cluster, term, count(*) AS tf FROM {p}tok WHERE term NOT IN ({stop}) GROUP BY cluster, term),
{p}voc AS (
  SELECT term, sum(tf) AS total, count(*) AS cf FROM {p}tf GROUP BY term ORDER BY total DESC, term ASC LIMIT 1000
),
{p}kept AS (
  SELECT f.cluster, f.term, f.tf, v.cf, sum(f.tf) OVER (PARTITION BY f.cluster) AS tf_sum
  FROM {p}tf f JOIN {p}voc v USING (term)
),
{p}sc AS (
  SELECT cluster, term, tf, cf, tf / (tf_sum + 1e-9) * ln((SELECT k FROM {p}k)::DOUBLE / (cf + 1)) AS score FROM {p}kept
),
{p}grid AS (
  SELECT c.cluster, v.term, coalesce(s.tf, 0) AS tf, coalesce(s.score, 0.0::DOUBLE) AS score
  FROM (SELECT DISTINCT cluster FROM {p}sc) c CROSS JOIN {p}voc v
  LEFT JOIN {p}sc s ON s.cluster = c.cluster AND s.term = v.term
),
{p}rank AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC,
    CASE WHEN score = 0 THEN term END DESC NULLS LAST, tf DESC, term ASC) AS rank
  FROM {p}grid
),
{p}kw AS (
  SELECT cluster, list(term ORDER BY rank) AS keywords FROM {p}rank
  WHERE rank <= 10 AND (SELECT k FROM {p}k) >= 2 GROUP BY cluster
)"""


def _representatives(p: str, rows: str) -> str:
    """``{p}rep(cluster, reps)``: the five ``value``s nearest to the centroid."""
    return f"""
{p}emb AS (
  SELECT cluster, ord, value, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS a,
         (length(text) - length(replace(text, 't', '')))::DOUBLE AS b, (length(text) % 97 + 1)::DOUBLE AS c
  FROM {rows}
),
{p}cen AS (SELECT cluster, avg(a) AS x, avg(b) AS y, avg(c) AS z FROM {p}emb GROUP BY cluster),
{p}sim AS (
  SELECT e.cluster, e.ord, e.value,
         (a * x + b * y + c * z) / (sqrt(a * a + b * b + c * c) * sqrt(x * x + y * y + z * z)) AS sim
  FROM {p}emb e JOIN {p}cen USING (cluster)
),
{p}top AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sim DESC, ord ASC) AS r FROM {p}sim QUALIFY r <= 5
),
{p}rep AS (SELECT cluster, list(value ORDER BY r) AS reps FROM {p}top GROUP BY cluster)"""


def _name(of: str) -> str:
    """The label of a fixed name answer (null: none that can be read)."""
    return (f"CASE WHEN length(coalesce({of}.keywords[1], '')) % 3 = 2 "
            f"THEN {of}.keywords[1] || ' ' || substr(r.reps[1], 1, 12) END")


def stages(posts_cte: str, stop: str) -> str:
    return f"""
WITH {posts_cte},
tc AS (
  SELECT ord, post_id, topic, text,
         CASE WHEN TRY_CAST(substr(topic, 4) AS INTEGER) % 5 <> 4 THEN TRY_CAST(substr(topic, 4) AS INTEGER) END AS cluster_id
  FROM posts
),
trows AS (SELECT cluster_id AS cluster, ord, text, text AS value FROM tc WHERE cluster_id IS NOT NULL),
{_keywords('t', 'trows', stop)},
{_representatives('t', 'trows')},
tmeta AS (
  SELECT c.cluster AS cluster_id, coalesce(k.keywords, []) AS keywords, {_name('k')} AS topic_label
  FROM (SELECT DISTINCT cluster FROM trows) c LEFT JOIN tkw k USING (cluster) LEFT JOIN trep r USING (cluster)
),
topics AS (SELECT tc.*, m.topic_label, m.keywords FROM tc LEFT JOIN tmeta m USING (cluster_id)),
nn AS (
  SELECT *, length(text) AS n FROM topics WHERE length(text) % 13 <> 0 AND length(text) % 11 <> 0
),
rec AS (
  SELECT ord, topic AS source_topic, topic_label,
         CASE n % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'pain with ' || substr(text, 1, 30) END AS pain,
         CASE WHEN n % 9 = 0 THEN '' ELSE 'opinion of ' || substr(text, 1, 25) END AS opinion,
         CASE WHEN n % 6 <> 0 THEN 'cause' || (n % 6) END AS root_cause,
         CASE n % 5 WHEN 0 THEN 'fear' WHEN 1 THEN 'joy' WHEN 2 THEN 'neutral' WHEN 3 THEN 'anger' ELSE 'curiosity' END AS emotion,
         least(1.0::DOUBLE, (n % 10) / 5.0::DOUBLE) AS intensity,
         CASE WHEN n % 8 = 0 THEN substr(text, 1, 60) ELSE 'quote ' || substr(text, 1, 20) END AS evidence,
         CASE n % 4 WHEN 0 THEN 'trader' WHEN 1 THEN 'developer' ELSE 'casual' END AS user_type,
         CASE n % 2 WHEN 0 THEN 'beginner' ELSE 'expert' END AS experience_level,
         make_timestamp((1705312800 + ord * 3600) * 1000000) AS ts
  FROM nn
),
nr AS (
  SELECT CAST(ord % 7 AS INTEGER) AS cluster, *, coalesce(nullif(pain, ''), opinion) AS text, evidence AS value
  FROM rec WHERE ord % 7 <> 6
),
{_keywords('n', 'nr', stop)},
{_representatives('n', 'nr')},
base AS (
  SELECT cluster, count(*) AS post_count, avg(intensity) AS mean_intensity, min(ord) AS first_ord,
         min(ts) AS first_ts, max(ts) AS last_ts
  FROM nr GROUP BY cluster
),
meta AS (
  SELECT b.*, coalesce(k.keywords, []) AS keywords, coalesce(r.reps, []) AS reps,
         coalesce({_name('k')}, 'Cluster ' || b.cluster) AS cluster_name,
         CASE length(coalesce(k.keywords[1], '')) % 3 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE 'About ' || k.keywords[-1] END AS description,
         length(coalesce(k.keywords[1], '')) % 4 AS tool
  FROM base b LEFT JOIN nkw k USING (cluster) LEFT JOIN nrep r USING (cluster)
),
pc AS (SELECT cluster, user_type, count(*) AS cnt, min(ord) AS f FROM nr GROUP BY 1, 2),
pt AS (SELECT *, sum(cnt) OVER (PARTITION BY cluster) AS total FROM pc),
pl AS (
  SELECT cluster, experience_level FROM (
    SELECT cluster, experience_level, count(*) AS cnt, min(ord) AS f FROM nr GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY cnt DESC, f ASC) = 1
),
people AS (
  SELECT pt.cluster, string_agg(user_type || ':' || cnt || ':' || CAST(round_even(cnt::DOUBLE / total * 100, 0) AS INTEGER)
         || ':' || experience_level, ',' ORDER BY cnt DESC, f ASC) AS personas
  FROM pt JOIN pl USING (cluster) WHERE cnt::DOUBLE / total > 0.2::DOUBLE GROUP BY pt.cluster
),
ec AS (SELECT cluster, emotion, count(*) AS cnt, min(ord) AS f FROM nr GROUP BY 1, 2),
emo AS (
  SELECT cluster, list(emotion ORDER BY cnt DESC, f ASC)[1:5] AS emotions FROM ec GROUP BY cluster
),
scen AS (
  SELECT cluster, list(root_cause ORDER BY root_cause)[1:5] AS scenarios FROM (
    SELECT DISTINCT cluster, root_cause FROM nr WHERE root_cause IS NOT NULL) GROUP BY cluster
),
tops AS (
  SELECT cluster, list(source_topic ORDER BY source_topic) AS source_topics FROM (
    SELECT DISTINCT cluster, source_topic FROM nr WHERE source_topic <> '') GROUP BY cluster
),
labs AS (
  SELECT cluster, list(topic_label ORDER BY topic_label) AS labels FROM (
    SELECT DISTINCT cluster, topic_label FROM nr WHERE topic_label <> '') GROUP BY cluster
),
vel AS (
  SELECT coalesce(avg((n % 7 - 3) / 20.0::DOUBLE), 0.0::DOUBLE) AS v FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)
),
tr AS (SELECT CASE WHEN v > 0.05::DOUBLE THEN 'rising' WHEN v < -0.05::DOUBLE THEN 'cooling' ELSE 'stable' END AS trend FROM vel),
scored AS (
  SELECT m.*, tr.trend, m.tool = 0 AS mature,
         least(10.0::DOUBLE, 3.0::DOUBLE + post_count * 0.3::DOUBLE + mean_intensity * 3.0::DOUBLE) AS imp,
         CASE WHEN m.tool = 0 THEN 7.0::DOUBLE ELSE 3.5::DOUBLE END AS sat,
         CASE WHEN trend = 'rising' THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS boost
  FROM meta m CROSS JOIN tr WHERE m.tool <> 3
),
rated AS (
  SELECT *, imp + greatest(imp - sat, 0.0::DOUBLE) AS raw,
         CASE WHEN mean_intensity > 0.7::DOUBLE THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
         * CASE WHEN mature THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END * boost AS weight
  FROM scored
),
clusters AS (
  SELECT *, round_even(raw, 2) AS raw_score, round_even(raw * weight, 2) AS final_score,
         row_number() OVER (ORDER BY round_even(raw * weight, 2) DESC, first_ord ASC) AS rank
  FROM rated
),
specs AS (
  SELECT *, length(cluster_name) % 3 AS kind,
         CASE WHEN length(cluster_name) % 3 = 0 THEN 9.0::DOUBLE ELSE imp END AS imp2,
         CASE WHEN length(cluster_name) % 3 = 0 THEN 2.0::DOUBLE ELSE sat END AS sat2
  FROM clusters WHERE rank <= 10 AND length(cluster_name) % 3 <> 2
),
refined AS (
  SELECT *, imp2 + greatest(imp2 - sat2, 0.0::DOUBLE) AS raw2,
         CASE WHEN round_even(mean_intensity, 3) > 0.7::DOUBLE THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
         * CASE WHEN kind = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END * boost AS weight2
  FROM specs
)"""


def add(q: dict[str, str], posts_cte: str, stop: str, latin: str) -> None:
    ctes = stages(posts_cte, stop)
    q["topic_stage"] = ctes + """
SELECT post_id, cluster_id, topic_label, CASE WHEN cluster_id IS NOT NULL THEN array_to_string(keywords, ',') END AS topic_keywords
FROM topics"""
    q["need_stage"] = ctes + """
SELECT rank, c.cluster AS need_cluster_id, cluster_name, description, post_count, trend,
       array_to_string(keywords, ',') AS keywords, array_to_string(reps, '|') AS evidence,
       coalesce(array_to_string(scenarios, ','), '') AS scenarios, coalesce(personas, '') AS personas,
       emotions[1] AS dominant_emotion, round_even(mean_intensity, 3) AS avg_intensity,
       array_to_string(emotions, ',') AS emotions,
       CASE tool WHEN 0 THEN 'Tool ' || coalesce(keywords[1], '') || ':full:' WHEN 1 THEN 'X:partial:' ELSE '' END AS solutions,
       coalesce(array_to_string(source_topics, ','), '') AS source_topics,
       coalesce(array_to_string(labels, '|'), '') AS source_topic_labels, raw_score, final_score
FROM clusters c LEFT JOIN people USING (cluster) LEFT JOIN emo USING (cluster) LEFT JOIN scen USING (cluster)
LEFT JOIN tops USING (cluster) LEFT JOIN labs USING (cluster)"""
    q["full_run"] = ctes + """
SELECT rank, cluster AS source_cluster_id, CASE kind WHEN 0 THEN 'fixed-skill' ELSE 's-' || length(cluster_name) END AS skill_name,
       cluster_name AS need_name, 'missing_feature' AS need_type, description AS need_description, post_count,
       strftime(first_ts, '%Y-%m-%d') || ' ~ ' || strftime(last_ts, '%Y-%m-%d') AS data_period,
       array_to_string(reps, '|') AS evidence, imp2 AS importance, sat2 AS satisfaction, round_even(raw2, 2) AS raw_score,
       boost AS trend_boost, round_even(raw2 * weight2, 2) AS final_score
FROM refined"""

    q["run_metrics"] = ctes + f""",
mm(stage, metric, value) AS (
  SELECT 'collect', 'raw', (SELECT count(*) FROM posts_raw)
  UNION ALL SELECT 'collect', 'short', (SELECT count(*) FROM posts_raw WHERE NOT length(text) > 20)
  UNION ALL SELECT 'collect', 'non_latin', (SELECT count(*) FROM posts_raw WHERE length(text) > 20 AND NOT {latin})
  UNION ALL SELECT 'collect', 'kept', (SELECT count(*) FROM posts_kept)
  UNION ALL SELECT 'dedup', 'unique', (SELECT count(*) FROM posts)
  UNION ALL SELECT 'topics', 'clustered', (SELECT count(cluster_id) FROM tc)
  UNION ALL SELECT 'topics', 'noise', (SELECT count(*) FROM tc WHERE cluster_id IS NULL)
  UNION ALL SELECT 'topics', 'clusters', (SELECT count(*) FROM tmeta)
  UNION ALL SELECT 'topics', 'named', (SELECT count(topic_label) FROM tmeta)
  UNION ALL SELECT 'extract', 'records', (SELECT count(*) FROM rec)
  UNION ALL SELECT 'extract', 'skipped_off_domain', (SELECT count(*) FROM posts WHERE length(text) % 11 = 0 AND length(text) % 13 <> 0)
  UNION ALL SELECT 'extract', 'errors', (SELECT count(*) FROM posts WHERE length(text) % 13 = 0)
  UNION ALL SELECT 'needs', 'clustered', (SELECT count(*) FROM nr)
  UNION ALL SELECT 'needs', 'noise', (SELECT count(*) FROM rec WHERE ord % 7 = 6)
  UNION ALL SELECT 'needs', 'clusters', (SELECT count(*) FROM base)
  UNION ALL SELECT 'specs', 'specs', (SELECT count(*) FROM specs)
  UNION ALL SELECT 'specs', 'errors', (SELECT count(*) FROM clusters WHERE rank <= 10 AND length(cluster_name) % 3 = 2)
)
SELECT stage, metric, value FROM mm"""

    features = """
u AS (SELECT user_id, count(*)::DOUBLE AS n, avg(value) AS m FROM events GROUP BY user_id),
st AS (SELECT avg(n) AS an, stddev_samp(n) AS sn, avg(m) AS am, stddev_samp(m) AS sm FROM u),
z AS (SELECT user_id, (n - an) / sn AS x, (m - am) / sm AS y FROM u CROSS JOIN st)"""
    q["reachability_tree"] = f"""
WITH RECURSIVE {features},
d AS (
  SELECT a.user_id AS a, b.user_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d
  FROM z a JOIN z b ON a.user_id <> b.user_id
),
core AS (SELECT a, list(d ORDER BY d)[3] AS core FROM d GROUP BY a),
w AS (
  SELECT d.a, d.b, greatest(d.d, p.core, q.core) AS w, least(d.a, d.b) AS lo, greatest(d.a, d.b) AS hi
  FROM d JOIN core p ON p.a = d.a JOIN core q ON q.a = d.b
),
grow(seen, lo, hi, w) AS (
  SELECT [min(user_id)], NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM z
  UNION ALL
  SELECT list_append(g.seen, e.b), e.lo, e.hi, e.w
  FROM grow g, LATERAL (
    SELECT b, lo, hi, w FROM w WHERE list_contains(g.seen, w.a) AND NOT list_contains(g.seen, w.b)
    ORDER BY w.w, w.lo, w.hi LIMIT 1) e
)
SELECT lo, hi, round(w, 9) AS w FROM grow WHERE lo IS NOT NULL"""
    q["nearest_neighbours"] = """
SELECT vec_id, CAST(row_number() OVER w AS INTEGER) AS rank, other, round(d, 9) AS dist FROM (
  SELECT a.vec_id, b.vec_id AS other, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
WINDOW w AS (PARTITION BY vec_id ORDER BY d, other) QUALIFY row_number() OVER w <= 5"""
