"""DuckDB SQL equal in meaning to each driver query (same column names).

Tables ``documents``, ``events`` ... are views over the same parquet files.
"""

from __future__ import annotations

from needlens.functions.text import english_stop_words, sql_whitespace


def _stop_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())


def _latin(t: str) -> str:
    letters = f"length(regexp_replace({t}, '\\P{{L}}', '', 'g'))"
    ascii_ = f"length(regexp_replace({t}, '[^A-Za-z]', '', 'g'))"
    return f"(CASE WHEN {letters} = 0 THEN false ELSE {ascii_}::DOUBLE / {letters} >= 0.6 END)"


def _posts_cte() -> str:
    """Documents as posts, filtered (F1, F2) and deduplicated by text."""
    ws = sql_whitespace()
    return f"""
posts_raw AS (
  SELECT doc_id AS ord, CAST(doc_id AS VARCHAR) AS post_id, source AS topic,
         trim(text, {ws}) AS text
  FROM documents
),
posts_kept AS (
  SELECT * FROM posts_raw WHERE length(text) > 20 AND {_latin('text')}
),
posts AS (
  SELECT * FROM posts_kept
  QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY ord) = 1
)"""


def build() -> dict[str, str]:
    ws = sql_whitespace()
    q: dict[str, str] = {}

    q["clean_posts"] = f"""
WITH d AS (SELECT doc_id, source, trim(text, {ws}) AS t FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS post_id,
       replace(replace(source, '-post', ''), '-', '_') AS network,
       length(t) AS n_chars, t AS text
FROM d WHERE length(t) > 20 AND {_latin('t')}"""

    q["latin_ratio"] = f"""
SELECT doc_id,
       length(regexp_replace(text, '\\P{{L}}', '', 'g')) AS n_letters,
       length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_ascii_letters,
       {_latin('text')} AS is_latin
FROM documents"""

    q["dedup_first"] = f"""
SELECT sha256(trim(text, {ws})) AS text_hash, min(doc_id) AS doc_id, count(*) AS n_copies
FROM documents GROUP BY 1"""

    q["ctfidf_keywords_by_source"] = f"""
WITH {_posts_cte()},
k AS (SELECT count(DISTINCT topic) AS k FROM posts),
toks AS (
  SELECT topic AS cluster, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term
  FROM posts
),
tf AS (
  SELECT cluster, term, count(*) AS tf FROM toks
  WHERE term NOT IN ({_stop_list()})
  GROUP BY cluster, term
),
vocab AS (
  SELECT term, sum(tf) AS total, count(*) AS cf FROM tf GROUP BY term
  ORDER BY total DESC, term ASC LIMIT 1000
),
kept AS (
  SELECT tf.cluster, tf.term, tf.tf, vocab.cf,
         sum(tf.tf) OVER (PARTITION BY tf.cluster) AS tf_sum
  FROM tf JOIN vocab USING (term)
),
scored AS (
  SELECT cluster, term, tf, cf,
         tf / (tf_sum + 1e-9) * ln((SELECT k FROM k)::DOUBLE / (cf + 1)) AS score
  FROM kept
),
grid AS (
  SELECT c.cluster, v.term, coalesce(s.tf, 0) AS tf, v.cf, coalesce(s.score, 0.0::DOUBLE) AS score
  FROM (SELECT DISTINCT cluster FROM scored) c CROSS JOIN vocab v
  LEFT JOIN scored s ON s.cluster = c.cluster AND s.term = v.term
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC,
    CASE WHEN score = 0 THEN term END DESC NULLS LAST, tf DESC, term ASC) AS rank
  FROM grid
)
SELECT cluster AS source, rank, term, tf, cf, round(score, 9) AS score
FROM ranked WHERE rank <= 10 AND (SELECT k FROM k) >= 2"""


    q["sentiment_rescale"] = """
SELECT CAST(event_id AS VARCHAR) AS post_id,
       coalesce(nullif(floor(value / 10) / 10, 0.0::DOUBLE), 2.5::DOUBLE) * 20.0::DOUBLE AS sentiment_lc,
       coalesce(nullif(CAST(props->>'$.k' AS BIGINT), 0), nullif(user_id, 0), 0) AS interactions,
       CASE WHEN ts IS NULL OR epoch(ts) = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
            ELSE date_trunc('second', ts) END AS timestamp
FROM events"""

    q["network_norm"] = """
WITH d AS (SELECT doc_id, concat_ws('-', lang, source, 'post') AS post_type FROM documents)
SELECT doc_id, post_type,
       replace(replace(post_type, '-post', ''), '-', '_') AS network,
       split_part(post_type, '-', 1) AS network_b
FROM d"""

    q["topic_norm"] = f"""
WITH d AS (
  SELECT doc_id, upper(lang) || '_' || source || '-Feed ' AS topic FROM documents
), n AS (
  SELECT doc_id, topic, trim(translate(lower(topic), '_-', '  '), {ws}) AS topic_norm FROM d
)
SELECT arg_min(doc_id, doc_id) AS doc_id, arg_min(topic, doc_id) AS topic, topic_norm, count(*) AS n_docs
FROM n GROUP BY topic_norm"""

    order_records = """
r AS (
  SELECT c.c_nationkey AS need_cluster_id, lower(c.c_mktsegment) AS user_type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expert'
              WHEN o.o_orderpriority = '3-MEDIUM' THEN 'intermediate' ELSE 'beginner' END AS experience_level,
         o.o_orderpriority AS root_cause, o.o_orderstatus AS source_topic, o.o_orderkey AS ord
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

    q["personas"] = f"""
WITH {order_records},
vc AS (SELECT need_cluster_id, user_type, count(*) AS cnt, min(ord) AS first_ord FROM r GROUP BY 1, 2),
vt AS (SELECT *, sum(cnt) OVER (PARTITION BY need_cluster_id) AS total FROM vc),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY need_cluster_id ORDER BY cnt DESC, first_ord ASC) AS persona_rank
  FROM vt WHERE cnt::DOUBLE / total > 0.2::DOUBLE
),
lv AS (
  SELECT need_cluster_id, experience_level FROM (
    SELECT need_cluster_id, experience_level, count(*) AS cnt, min(ord) AS first_ord FROM r GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY need_cluster_id ORDER BY cnt DESC, first_ord ASC) = 1
)
SELECT k.need_cluster_id, persona_rank, user_type AS segment_name, cnt AS post_count,
       CAST(round_even(cnt::DOUBLE / total * 100, 0) AS INTEGER) AS pct, lv.experience_level
FROM kept k JOIN lv USING (need_cluster_id)"""

    q["emotion_profile"] = """
WITH r AS (
  SELECT user_id % 10 AS need_cluster_id, event_type AS emotion,
         least(greatest(value / 100, 0.0::DOUBLE), 1.0::DOUBLE) AS intensity, event_id AS ord
  FROM events
),
vc AS (SELECT need_cluster_id, emotion, count(*) AS cnt, min(ord) AS first_ord FROM r GROUP BY 1, 2),
vt AS (
  SELECT *, sum(cnt) OVER (PARTITION BY need_cluster_id) AS total,
         row_number() OVER (PARTITION BY need_cluster_id ORDER BY cnt DESC, first_ord ASC) AS emotion_rank
  FROM vc
),
dom AS (SELECT need_cluster_id, emotion AS dominant_emotion FROM vt WHERE emotion_rank = 1),
st AS (SELECT need_cluster_id, avg(intensity) AS mean_intensity FROM r GROUP BY 1)
SELECT t.need_cluster_id, emotion_rank, emotion, round_even(cnt::DOUBLE / total, 3) AS share,
       dominant_emotion, round_even(mean_intensity, 3) AS avg_intensity,
       round(mean_intensity, 9) AS mean_intensity, CAST(total AS BIGINT) AS post_count
FROM vt t JOIN dom USING (need_cluster_id) JOIN st USING (need_cluster_id)
WHERE emotion_rank <= 5"""

    daily = """
daily_all AS (
  SELECT event_type AS topic, CAST(ts AS DATE) AS day, count(*) AS n_events,
         avg(value) AS avg_sentiment, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS interactions
  FROM events GROUP BY 1, 2
),
daily AS (
  SELECT topic, day, n_events, avg_sentiment, interactions FROM (
    SELECT *, max(day) OVER (PARTITION BY topic) AS last FROM daily_all)
  WHERE day > last - 14
)"""

    q["daily_series"] = f"""
WITH {daily}
SELECT topic, day, n_events, round(avg_sentiment, 9) AS avg_sentiment, interactions FROM daily"""

    q["trend_series"] = f"""
WITH {daily},
pts AS (
  SELECT topic AS series, topic, day, avg_sentiment FROM daily
  UNION ALL SELECT '*' AS series, topic, day, avg_sentiment FROM daily
),
p AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY topic, day) AS pos,
         count(*) OVER (PARTITION BY series) AS n
  FROM pts WHERE avg_sentiment IS NOT NULL AND avg_sentiment <> 0
),
a AS (
  SELECT series, count(*) AS n_points,
         avg(CASE WHEN pos > floor(n / 2) THEN avg_sentiment END)
         - avg(CASE WHEN pos <= floor(n / 2) THEN avg_sentiment END) AS diff
  FROM p GROUP BY series
)
SELECT series AS topic, n_points, round(diff, 9) AS diff,
       CASE WHEN n_points < 4 THEN 'stable' WHEN diff > 3 THEN 'rising'
            WHEN diff < -3 THEN 'cooling' ELSE 'stable' END AS trend
FROM a"""

    velocity = """
vd AS (
  SELECT topic, day, n, max(day) OVER (PARTITION BY topic) AS last FROM (
    SELECT event_type AS topic, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
),
va AS (
  SELECT topic,
         CAST(coalesce(sum(CASE WHEN last - day < 7 THEN n END), 0) AS BIGINT) AS recent,
         CAST(coalesce(sum(CASE WHEN last - day >= 7 AND last - day < 14 THEN n END), 0) AS BIGINT) AS prior
  FROM vd GROUP BY topic
),
v AS (
  SELECT topic, recent, prior,
         CASE WHEN prior > 0 THEN (recent - prior)::DOUBLE / prior END AS velocity
  FROM va
),
vall AS (
  SELECT topic, recent, prior, velocity FROM v
  UNION ALL
  SELECT '*', NULL, NULL, coalesce(avg(coalesce(velocity, 0.0::DOUBLE)), 0.0::DOUBLE) FROM v
),
vt AS (
  SELECT *, CASE WHEN coalesce(velocity, 0) > 0.05::DOUBLE THEN 'rising'
                 WHEN coalesce(velocity, 0) < -0.05::DOUBLE THEN 'cooling' ELSE 'stable' END AS trend
  FROM vall
)"""

    q["trend_velocity"] = f"""
WITH {velocity}
SELECT topic, recent, prior, round(velocity, 9) AS velocity, trend FROM vt"""

    opp = f"""
{velocity},
g AS (SELECT trend FROM vt WHERE topic = '*'),
er AS (
  SELECT user_id, event_type, value,
         least(greatest(value / 100, 0.0::DOUBLE), 1.0::DOUBLE) AS intensity, event_id AS ord
  FROM events
),
ea AS (
  SELECT user_id, event_type, count(*) AS post_count, avg(intensity) AS mean_intensity,
         bool_or(value >= 480) AS has_mature_solution, min(ord) AS first_ord
  FROM er GROUP BY 1, 2
),
es AS (
  SELECT ea.*, g.trend,
         least(10.0::DOUBLE, 3.0::DOUBLE + post_count * 0.3::DOUBLE + mean_intensity * 3.0::DOUBLE) AS importance,
         CASE WHEN has_mature_solution THEN 7.0::DOUBLE ELSE 3.5::DOUBLE END AS satisfaction
  FROM ea CROSS JOIN g
),
et AS (
  SELECT *, importance + greatest(importance - satisfaction, 0.0::DOUBLE) AS raw,
         CASE WHEN mean_intensity > 0.7::DOUBLE THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS intensity_weight,
         CASE WHEN has_mature_solution THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS solution_weight,
         CASE WHEN trend = 'rising' THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS trend_boost
  FROM es
),
opp AS (
  SELECT *, round_even(raw, 2) AS raw_score,
         round_even(raw * intensity_weight * solution_weight * trend_boost, 2) AS final_score
  FROM et
)"""

    q["opportunity"] = f"""
WITH {opp}
SELECT user_id, event_type, post_count, round(mean_intensity, 9) AS mean_intensity, has_mature_solution,
       round(importance, 9) AS importance, satisfaction, raw_score, intensity_weight, solution_weight,
       trend_boost, final_score, trend, first_ord
FROM opp"""

    q["top_clusters"] = f"""
WITH {opp}
SELECT user_id, event_type, first_ord, final_score,
       row_number() OVER (ORDER BY final_score DESC, first_ord ASC) AS rank
FROM opp QUALIFY rank <= 10"""

    q["source_sets"] = f"""
WITH {order_records},
rc AS (
  SELECT need_cluster_id, string_agg(root_cause, ',' ORDER BY root_cause) AS top_scenarios FROM (
    SELECT * FROM (SELECT DISTINCT need_cluster_id, root_cause FROM r
                   WHERE root_cause IS NOT NULL AND root_cause <> '')
    QUALIFY row_number() OVER (PARTITION BY need_cluster_id ORDER BY root_cause) <= 5)
  GROUP BY 1
),
st AS (
  SELECT need_cluster_id, string_agg(source_topic, ',' ORDER BY source_topic) AS source_topics FROM (
    SELECT DISTINCT need_cluster_id, source_topic FROM r
    WHERE source_topic IS NOT NULL AND source_topic <> '')
  GROUP BY 1
)
SELECT need_cluster_id, top_scenarios, source_topics FROM rc FULL JOIN st USING (need_cluster_id)"""

    q["creator_join"] = """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, c.c_acctbal
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""

    q["persona_matrix"] = f"""
WITH {order_records}
SELECT need_cluster_id, count(*) FILTER (WHERE user_type = 'automobile') AS "AUTOMOBILE",
       count(*) FILTER (WHERE user_type = 'building') AS "BUILDING",
       count(*) FILTER (WHERE user_type = 'furniture') AS "FURNITURE",
       count(*) FILTER (WHERE user_type = 'household') AS "HOUSEHOLD",
       count(*) FILTER (WHERE user_type = 'machinery') AS "MACHINERY"
FROM r GROUP BY need_cluster_id"""

    q["topics_over_time"] = """
SELECT event_type AS topic, CAST(ts AS DATE) AS day, count(*) AS n_posts, count(DISTINCT user_id) AS n_users
FROM events GROUP BY 1, 2"""

    q["top_per_topic"] = """
SELECT event_type AS topic, event_id, value,
       row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id ASC) AS rank
FROM events QUALIFY rank <= 50"""

    q["stage_metrics"] = f"""
WITH p AS (SELECT source, doc_id AS ord, trim(text, {ws}) AS text FROM documents),
f AS (SELECT *, NOT (length(text) > 20) AS short FROM p),
g AS (SELECT *, (NOT short) AND NOT {_latin('text')} AS nonlatin FROM f),
k AS (SELECT source, ord, sha256(text) AS h FROM g WHERE NOT short AND NOT nonlatin),
fi AS (SELECT h, min(ord) AS first FROM k GROUP BY h),
d AS (
  SELECT source, count(*) AS n_kept, count(*) FILTER (WHERE ord <> first) AS n_duplicates
  FROM k JOIN fi USING (h) GROUP BY source
),
r AS (
  SELECT source, count(*) AS n_raw, count(*) FILTER (WHERE short) AS n_short,
         count(*) FILTER (WHERE nonlatin) AS n_non_latin
  FROM g GROUP BY source
)
SELECT r.source, n_raw, n_short, n_non_latin, coalesce(n_kept, 0) AS n_kept,
       coalesce(n_duplicates, 0) AS n_duplicates,
       coalesce(n_kept, 0) - coalesce(n_duplicates, 0) AS n_unique
FROM r LEFT JOIN d USING (source)"""

    fresh = """
puts AS (
  SELECT sha256('events:' || event_type || ':' || CAST(user_id AS VARCHAR)) AS cache_key,
         props AS value, ts AS written_at,
         ts + to_hours(CAST(floor(value / 10) AS INTEGER)) AS expires, event_id AS seq
  FROM events
),
fresh AS (
  SELECT * FROM (
    SELECT * FROM puts WHERE written_at <= TIMESTAMP '2024-01-20 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY written_at DESC, seq DESC) = 1)
  WHERE expires >= TIMESTAMP '2024-01-20 00:00:00'
)"""

    q["fresh_results"] = f"""
WITH {fresh}
SELECT cache_key, value, written_at, expires FROM fresh"""

    q["missing_keys"] = f"""
WITH {fresh},
req AS (
  SELECT DISTINCT sha256('events:' || event_type || ':' || CAST(user_id AS VARCHAR)) AS cache_key,
         event_type, user_id
  FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
)
SELECT * FROM req WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh.cache_key = req.cache_key)"""

    q["stored_or_fetched"] = f"""
WITH {fresh},
since AS (
  SELECT cache_key, value FROM puts WHERE written_at > TIMESTAMP '2024-01-20 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY written_at DESC, seq DESC) = 1
)
SELECT s.cache_key, CASE WHEN f.cache_key IS NULL THEN s.value ELSE f.value END AS value,
       f.cache_key IS NOT NULL AS stored
FROM since s LEFT JOIN fresh f USING (cache_key)"""

    q["purged_results"] = f"""
WITH {fresh}
SELECT cache_key, value, written_at, expires, seq FROM puts
WHERE expires >= TIMESTAMP '2024-01-20 00:00:00'
  AND cache_key NOT IN (
    SELECT sha256('events:' || event_type || ':' || CAST(user_id AS VARCHAR)) FROM events
    WHERE ts > TIMESTAMP '2024-01-20 00:00:00' AND event_type = 'signup')"""

    runs = """
s AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id,
         CASE WHEN event_type = 'signup' THEN 'pending'
              WHEN event_type IN ('view', 'click') THEN 'running'
              WHEN event_type = 'purchase' THEN 'completed' ELSE 'failed' END AS status,
         ts, event_id AS seq
  FROM events
),
l AS (
  SELECT run_id, status, ts AS updated_at FROM s
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) = 1
),
g AS (
  SELECT run_id, max(CASE WHEN status = 'pending' THEN ts END) AS last_pending, min(ts) AS first
  FROM s GROUP BY run_id
),
runs AS (
  SELECT l.run_id, l.status, coalesce(g.last_pending, g.first) AS created_at, l.updated_at,
         CASE WHEN l.status IN ('completed', 'failed') THEN l.updated_at END AS completed_at
  FROM l JOIN g USING (run_id)
)"""

    q["run_latest"] = f"""
WITH {runs}
SELECT * FROM runs"""

    q["run_list"] = f"""
WITH {runs}
SELECT run_id, status, created_at,
       row_number() OVER (ORDER BY created_at DESC, run_id ASC) AS list_rank
FROM runs"""

    centroid_long = """
cl AS (
  SELECT label, CAST(pos - 1 AS INTEGER) AS dim, avg(x::DOUBLE) AS mean, count(*) AS n_points FROM (
    SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS pos
    FROM embeddings WHERE label IS NOT NULL)
  GROUP BY 1, 2
)"""

    q["cluster_centroids"] = f"""
WITH {centroid_long}
SELECT label, dim, round(mean, 9) AS mean, n_points FROM cl"""

    q["representatives"] = f"""
WITH {centroid_long},
c AS (SELECT label, list(mean ORDER BY dim) AS centroid FROM cl GROUP BY label),
s AS (
  SELECT e.label, e.vec_id,
         CASE WHEN sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(c.centroid, c.centroid)) = 0 THEN 0.0::DOUBLE
              ELSE list_dot_product(e.embedding::DOUBLE[], c.centroid)
                   / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(c.centroid, c.centroid))) END AS sim
  FROM embeddings e JOIN c USING (label)
)
SELECT label, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id ASC) AS rep_rank,
       vec_id, round(sim, 9) AS sim
FROM s QUALIFY rep_rank <= 5"""

    q["radius_pairs"] = """
SELECT a.vec_id AS id_a, b.vec_id AS id_b,
       round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS dist
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) <= 1.15::DOUBLE"""

    q["grid_pairs"] = """
WITH u AS (SELECT user_id, count(*)::DOUBLE AS n, avg(value) AS m FROM events GROUP BY user_id),
st AS (SELECT avg(n) AS an, stddev_samp(n) AS sn, avg(m) AS am, stddev_samp(m) AS sm FROM u),
z AS (SELECT user_id, (n - an) / sn AS x, (m - am) / sm AS y FROM u CROSS JOIN st)
SELECT a.user_id AS id_a, b.user_id AS id_b,
       round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 9) AS dist
FROM z a JOIN z b ON a.user_id < b.user_id
WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.25::DOUBLE"""

    q["density_clusters"] = """
WITH RECURSIVE
u AS (SELECT user_id, count(*)::DOUBLE AS n, avg(value) AS m FROM events GROUP BY user_id),
st AS (SELECT avg(n) AS an, stddev_samp(n) AS sn, avg(m) AS am, stddev_samp(m) AS sm FROM u),
z AS (SELECT user_id, (n - an) / sn AS x, (m - am) / sm AS y FROM u CROSS JOIN st),
pairs AS (
  SELECT a.user_id AS a, b.user_id AS b FROM z a JOIN z b ON a.user_id < b.user_id
  WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.25::DOUBLE
),
ends AS (SELECT a AS node FROM pairs UNION ALL SELECT b FROM pairs),
core AS (SELECT node FROM ends GROUP BY node HAVING count(*) >= 3),
ce AS (SELECT a, b FROM pairs WHERE a IN (SELECT node FROM core) AND b IN (SELECT node FROM core)),
sym AS (SELECT a AS src, b AS dst FROM ce UNION ALL SELECT b, a FROM ce),
reach(node, comp) AS (
  SELECT node, node FROM core
  UNION
  SELECT s.dst, r.comp FROM reach r JOIN sym s ON r.node = s.src
),
comp AS (SELECT node, min(comp) AS component FROM reach GROUP BY node),
sizes AS (SELECT component, count(*) AS size, min(node) AS first_ord FROM comp GROUP BY component HAVING count(*) >= 5),
ids AS (SELECT component, CAST(row_number() OVER (ORDER BY first_ord, component) - 1 AS INTEGER) AS cluster_id FROM sizes)
SELECT u.user_id, ids.cluster_id
FROM u LEFT JOIN comp ON comp.node = u.user_id LEFT JOIN ids ON ids.component = comp.component"""
    q["feed_ingest"] = f"""
WITH p AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id,
         trim(lang || CASE WHEN text <> '' THEN ' ' || text ELSE '' END, {ws}) AS text,
         CASE WHEN doc_id % 10 <> 0 THEN replace(replace(source || '-post', '-post', ''), '-', '_')
              ELSE 'unknown' END AS network,
         lang AS creator_id, n_chars AS creator_followers,
         coalesce(nullif(n_chars % 7, 0), nullif(n_chars % 5, 0), 0) AS interactions,
         (CASE WHEN n_chars % 6 = 0 THEN 2.5::DOUBLE ELSE (n_chars % 6)::DOUBLE END) * 20.0::DOUBLE AS sentiment_lc,
         CASE WHEN doc_id % 9 = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
              ELSE make_timestamp((1705312800 + doc_id * 60) * 1000000) END AS timestamp,
         source AS topic
  FROM documents
)
SELECT * FROM p WHERE length(text) > 20 AND {_latin('text')}"""
    bad = "(doc_id % 14 = 3 OR doc_id % 17 = 5 OR doc_id % 19 = 0)"
    q["single_topic_feed"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS post_id, 'every-source' AS topic,
       trim(lang || CASE WHEN text <> '' THEN ' ' || text ELSE '' END, {ws}) AS text,
       replace(replace(source || '-post', '-post', ''), '-', '_') AS network,
       coalesce(nullif(n_chars % 7, 0), nullif(n_chars % 5, 0), 0) AS interactions,
       (CASE WHEN n_chars % 6 = 0 THEN 2.5::DOUBLE ELSE (n_chars % 6)::DOUBLE END) * 20.0::DOUBLE AS sentiment_lc,
       make_timestamp((1705312800 + doc_id * 60) * 1000000) AS timestamp,
       (SELECT max(doc_id // 50) / 100.0::DOUBLE FROM documents) AS velocity
FROM documents WHERE NOT {bad}"""
    q["feed_states"] = f"""
SELECT source AS topic, count(*) AS n_posts, count(*) FILTER (WHERE {bad}) AS n_malformed,
       max(doc_id // 50) / 100.0::DOUBLE AS velocity
FROM documents GROUP BY source"""
    q["flat_feed"] = """
SELECT CAST(doc_id AS VARCHAR) AS post_id, 'flat' AS topic, text,
       CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN split_part(source || '-post', '-', 1) ELSE 'unknown' END AS network,
       lang AS creator_id, coalesce(nullif(n_chars % 7, 0), nullif(n_chars % 5, 0), 0) AS interactions,
       CASE WHEN doc_id % 6 = 0 AND n_chars % 5 <> 0 THEN (n_chars % 5)::DOUBLE
            WHEN doc_id % 6 < 2 THEN (30 + doc_id % 7)::DOUBLE ELSE 50.0::DOUBLE END AS sentiment_lc,
       CASE WHEN doc_id % 5 = 0 THEN TIMESTAMP '2024-02-01 10:00:00'
            WHEN doc_id % 5 < 3 THEN make_timestamp((1705312800 + doc_id * 60) * 1000000)
            ELSE TIMESTAMP '2024-01-01 00:00:00' END AS timestamp
FROM documents WHERE doc_id % 29 <> 3 AND doc_id % 23 <> 7"""

    from needlens.plans.prompts import SOLUTIONS
    tmpl = "'" + SOLUTIONS.replace("'", "''") + "'"
    quote = "chr(39)"  # a single quote, as in Python's list text
    plist = ("'[' || array_to_string(list_transform(list_slice(string_split(p_type, ' '), 1, 3), "
             f"lambda x: {quote} || x || {quote}), ', ') || ']'")
    rendered = (f"replace(replace(replace({tmpl}, '{{cluster_name}}', {plist}), '{{description}}', p_name), "
                f"'{{keywords}}', array_to_string(string_split(p_name, ' '), ', '))")
    q["render_prompts"] = f"""
SELECT p_partkey, {rendered} AS prompt, length({rendered}) AS prompt_chars FROM part"""

    from needlens.plans import oracle_answers, oracle_specs, oracle_stages
    oracle_answers.add(q)
    oracle_specs.add(q, opp)
    oracle_stages.add(q, _posts_cte(), _stop_list(), _latin('text'))
    return q
