"""DuckDB SQL for the spec refinement and report queries."""

from __future__ import annotations

from needlens.sources import sinks


def add(q: dict[str, str], opp_cte: str) -> None:
    top = f"""
WITH {opp_cte},
spans AS (SELECT user_id, event_type, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1, 2),
top AS (
  SELECT opp.*, spans.first_ts, spans.last_ts,
         row_number() OVER (ORDER BY final_score DESC, first_ord ASC) AS rank
  FROM opp JOIN spans USING (user_id, event_type)
  QUALIFY rank <= 10
),
lab AS (SELECT doc_id AS user_id, quality, toxic FROM labels),
ref AS (
  SELECT top.*, lab.quality, lab.toxic,
         CASE WHEN lab.quality IS NULL THEN importance ELSE (5 + 4 * lab.quality)::DOUBLE END AS imp2,
         CASE WHEN lab.quality IS NULL THEN satisfaction ELSE (2 + 3 * lab.toxic)::DOUBLE END AS sat2,
         coalesce(lab.quality = 1, false) AS mature2,
         CASE WHEN lab.quality IS NULL THEN ''
              ELSE 'skill-' || top.user_id || '-' || top.event_type END AS skill_name
  FROM top LEFT JOIN lab USING (user_id)
),
sc AS (
  SELECT *, imp2 + greatest(imp2 - sat2, 0.0::DOUBLE) AS raw2,
         CASE WHEN round_even(mean_intensity, 3) > 0.7::DOUBLE THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS iw2,
         CASE WHEN mature2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS sw2
  FROM ref
),
specs AS (
  SELECT rank, first_ord AS source_cluster_id, skill_name, 'Cluster ' || first_ord AS need_name,
         'missing_feature' AS need_type, imp2 AS importance, sat2 AS satisfaction,
         round_even(raw2, 2) AS raw_score, iw2 AS intensity_weight, sw2 AS solution_weight,
         trend_boost, round_even(raw2 * iw2 * sw2 * trend_boost, 2) AS final_score,
         strftime(first_ts, '%Y-%m-%d') || ' ~ ' || strftime(last_ts, '%Y-%m-%d') AS data_period,
         post_count, event_type, trend, round_even(mean_intensity, 3) AS avg_intensity
  FROM sc
)"""
    q["refined_specs"] = top + """
SELECT rank, source_cluster_id, skill_name, need_name, need_type, importance, satisfaction, raw_score,
       intensity_weight, solution_weight, trend_boost, final_score, data_period, post_count
FROM specs"""

    n = "(SELECT count(*) FROM specs)"
    method = ", ".join(f"(10 + {n} + 3 + {n} * 1000 + {i}, '{line}')"
                       for i, line in enumerate((sinks.METHOD_HEADER, *sinks.METHOD_LINES)))
    q["report_rows"] = top + f""",
head(line_no, line) AS (
  SELECT * FROM (VALUES (0, '{sinks.TITLE.format(date="events")}'), (1, ''),
                        (2, '- 帖子总量：' || (SELECT count(*) FROM events) || ' 条'),
                        (3, '- 需求簇：' || (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) || ' 个'),
                        (4, '- 输出 Skill：' || {n} || ' 个'), (5, ''), (6, '{sinks.TOP_HEADER}'), (7, ''),
                        (8, '{sinks.TABLE_HEAD}'),
                        (9, '{sinks.TABLE_RULE}'))
),
tbl AS (
  SELECT 10 + rank - 1 AS line_no,
         '| ' || rank || ' | `' || skill_name || '` | ' || need_name || ' | ' || CAST(final_score AS VARCHAR)
         || ' | ' || CASE trend WHEN 'rising' THEN '📈' WHEN 'cooling' THEN '📉' ELSE '➡️' END
         || ' | ' || event_type || ' | — |' AS line
  FROM specs
),
mid AS (
  SELECT 10 + {n} AS line_no, '' AS line
  UNION ALL SELECT 10 + {n} + 1, '{sinks.DETAIL_HEADER}'
  UNION ALL SELECT 10 + {n} + 2, ''
),
det AS (
  SELECT 10 + {n} + 3 + (rank - 1) * 1000 + i AS line_no, line FROM (
    SELECT rank, unnest(range(0, 9)) AS i,
           unnest([ '### ' || skill_name, '{sinks.NEED}', '{sinks.TOPICS}' || event_type, '{sinks.LABELS}{sinks.EMPTY}',
                    '{sinks.PERSONAS}', '{sinks.SCORE}' || CAST(final_score AS VARCHAR) || ' (importance='
                      || CAST(importance AS VARCHAR) || ', satisfaction=' || CAST(satisfaction AS VARCHAR) || ')',
                    '{sinks.EMOTION}' || event_type || ' (intensity=' || CAST(avg_intensity AS VARCHAR) || ')',
                    '{sinks.EVIDENCE}', '' ]) AS line
    FROM specs)
),
tail(line_no, line) AS (
  SELECT * FROM (VALUES {method})
)
SELECT CAST(line_no AS BIGINT) AS line_no, line FROM (
  SELECT * FROM head UNION ALL SELECT * FROM tbl UNION ALL SELECT * FROM mid
  UNION ALL SELECT * FROM det UNION ALL SELECT * FROM tail)"""
