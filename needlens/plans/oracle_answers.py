"""DuckDB SQL for the answer-parsing queries (tolerant JSON parse and the
field rules), kept apart from the table queries."""

from __future__ import annotations

from needlens.functions.text import sql_whitespace

_NUM_TYPES = "('BIGINT', 'UBIGINT', 'DOUBLE')"


def jt(f: str) -> str:
    return f"json_type(j, '$.{f}')"


def jstr(f: str) -> str:
    return f"(CASE WHEN {jt(f)} = 'VARCHAR' THEN j->>'$.{f}' END)"


def falsy(f: str) -> str:
    t = jt(f)
    return (f"({t} IS NULL OR {t} = 'NULL' "
            f"OR ({t} = 'BOOLEAN' AND (j->>'$.{f}') = 'false') "
            f"OR ({t} IN {_NUM_TYPES} AND (j->>'$.{f}')::DOUBLE = 0) "
            f"OR ({t} = 'VARCHAR' AND (j->>'$.{f}') = '') "
            f"OR ({t} = 'ARRAY' AND json_array_length(j, '$.{f}') = 0) "
            f"OR ({t} = 'OBJECT' AND (j->'$.{f}')::VARCHAR = '{{}}'))")


def text_or(f: str, default: str) -> tuple[str, str]:
    return (f"(CASE WHEN {falsy(f)} THEN {default} ELSE {jstr(f)} END)",
            f"({falsy(f)} OR {jt(f)} = 'VARCHAR')")


def opt_text(f: str) -> tuple[str, str]:
    return jstr(f), f"({jt(f)} IS NULL OR {jt(f)} IN ('NULL', 'VARCHAR'))"


def enum_or(f: str, allowed: tuple[str, ...], default: str) -> tuple[str, str]:
    lst = ", ".join(f"'{a}'" for a in allowed)
    return (f"(CASE WHEN {jstr(f)} IN ({lst}) THEN {jstr(f)} ELSE '{default}' END)",
            f"(coalesce({jt(f)} NOT IN ('ARRAY', 'OBJECT'), true))")


def number(f: str) -> str:
    t = jt(f)
    return (f"(CASE WHEN {t} = 'BOOLEAN' THEN CASE WHEN (j->>'$.{f}') = 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
            f"WHEN {t} IN {_NUM_TYPES} THEN (j->>'$.{f}')::DOUBLE "
            f"WHEN {t} = 'VARCHAR' THEN TRY_CAST(trim(j->>'$.{f}') AS DOUBLE) END)")


def clamp(f: str, default: float) -> tuple[str, str]:
    val = f"(CASE WHEN {jt(f)} IS NULL THEN {default}::DOUBLE ELSE {number(f)} END)"
    return (f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {val}))",
            f"({jt(f)} IS NULL OR {number(f)} IS NOT NULL)")


def number_or(f: str, default: str) -> tuple[str, str]:
    return (f"(CASE WHEN {jt(f)} IS NULL THEN {default} ELSE {number(f)} END)",
            f"({jt(f)} IS NULL OR {number(f)} IS NOT NULL)")


def flag_or(f: str) -> str:
    t = jt(f)
    return (f"(CASE WHEN {t} = 'BOOLEAN' THEN (j->>'$.{f}') = 'true' "
            f"WHEN {t} = 'VARCHAR' THEN lower(trim(j->>'$.{f}')) IN ('true', 'yes', '1') "
            f"WHEN {t} IN {_NUM_TYPES} THEN (j->>'$.{f}')::DOUBLE <> 0 ELSE false END)")


def esc(x: str) -> str:
    return f"replace(replace(replace({x}, chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"


def cleaned(col: str) -> str:
    """Strip, drop fences, turn \\' into '."""
    ws = sql_whitespace()
    s1 = f"trim({col}, {ws})"
    s2 = f"(CASE WHEN starts_with({s1}, '```json') THEN substr({s1}, 8) ELSE {s1} END)"
    s3 = f"(CASE WHEN starts_with({s2}, '```') THEN substr({s2}, 4) ELSE {s2} END)"
    s4 = f"(CASE WHEN ends_with({s3}, '```') THEN left({s3}, length({s3}) - 3) ELSE {s3} END)"
    return f"replace(trim({s4}, {ws}), chr(92) || chr(39), chr(39))"


def parsed_cte(src: str, keep_cols: str) -> str:
    """CTEs ``cleaned`` and ``parsed`` (column ``j`` JSON or NULL) over ``src(answer)``."""
    span = "regexp_extract(s1, '(?s)(\\{.*\\}|\\[.*\\])', 1)"
    return f"""
cleaned AS (SELECT {keep_cols}, {cleaned('answer')} AS s1 FROM {src}),
parsed AS (
  SELECT {keep_cols},
         CASE WHEN json_valid(s1) THEN s1::JSON
              WHEN json_valid({esc('s1')}) THEN ({esc('s1')})::JSON
              WHEN {span} <> '' AND json_valid({esc(span)}) THEN ({esc(span)})::JSON END AS j
  FROM cleaned
)"""


ANSWERS_CTE = """
ans_src AS (
  SELECT event_id, user_id AS u, event_type AS t, CAST(props->>'$.k' AS BIGINT) AS k,
         'event ' || event_id || ' of user ' || user_id || ' ' || event_type AS text
  FROM events
),
ans_body AS (
  SELECT *, '{' || concat_ws(', ',
    '"is_financial": ' || (CASE WHEN t = 'error' THEN 'false' WHEN t = 'view' THEN NULL ELSE 'true' END),
    '"entity": ' || (CASE WHEN k % 4 = 0 THEN '""' WHEN k = 7 THEN '5' ELSE '"' || t || '"' END),
    '"feature": "f' || k || '"',
    '"opinion": ' || (CASE WHEN event_id % 7 = 3 THEN '"it' || chr(92) || chr(39) || 's bad"'
                           WHEN event_id % 7 = 4 THEN '"line1' || chr(10) || 'line2"'
                           ELSE '"opinion ' || u || '"' END),
    '"need_type": ' || (CASE WHEN k % 13 = 0 THEN '["explicit"]' WHEN k % 2 = 1 THEN '"explicit"' ELSE '"implicit"' END),
    '"pain_point": ' || (CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'null' ELSE '"pain ' || k || '"' END),
    '"root_cause": ' || (CASE WHEN u % 5 = 0 THEN '12' ELSE '"cause' || (u % 4) || '"' END),
    '"sentiment": ' || (CASE WHEN u % 3 = 0 THEN '"positive"' WHEN u % 3 = 1 THEN '"mixed"' ELSE '"negative"' END),
    '"emotion": ' || (CASE WHEN k % 5 = 0 THEN '""' ELSE '"' || t || '"' END),
    '"intensity": ' || (CASE WHEN event_id % 11 = 0 THEN 'null' WHEN event_id % 13 = 0 THEN NULL
                             WHEN event_id % 5 = 0 THEN '"' || k || 'e-2"' ELSE (k * 2) || 'e-2' END),
    '"evidence": ' || (CASE WHEN k % 6 = 0 THEN NULL ELSE '"ev ' || event_id || '"' END),
    '"user_type": "' || (['trader', 'developer', 'investor', 'researcher', 'casual', 'alien'])[u % 6 + 1] || '"',
    '"experience_level": "' || (['beginner', 'intermediate', 'expert'])[event_id % 3 + 1] || '"'
  ) || '}' AS body
  FROM ans_src
),
answers AS (
  SELECT event_id, text,
         CASE WHEN event_id % 7 = 1 THEN '```json' || chr(10) || body || chr(10) || '```'
              WHEN event_id % 7 = 2 THEN 'Here is the analysis: ' || body || ' Hope this helps.'
              WHEN event_id % 7 = 5 THEN 'Sorry, I cannot help with that.'
              WHEN event_id % 7 = 6 THEN '[' || body || ']'
              ELSE body END AS answer
  FROM ans_body
)"""


def add(q: dict[str, str]) -> None:
    fields = {
        "entity": text_or("entity", "'unknown'"),
        "feature": text_or("feature", "'unknown'"),
        "opinion": text_or("opinion", "''"),
        "need_type": enum_or("need_type", ("explicit", "implicit"), "implicit"),
        "pain_point": opt_text("pain_point"),
        "root_cause": opt_text("root_cause"),
        "sentiment": enum_or("sentiment", ("positive", "negative", "neutral"), "neutral"),
        "emotion": text_or("emotion", "'neutral'"),
        "intensity": clamp("intensity", 0.5),
        "evidence": text_or("evidence", "substr(text, 1, 60)"),
        "user_type": enum_or("user_type", ("trader", "developer", "investor", "researcher", "casual"), "casual"),
        "experience_level": enum_or("experience_level", ("beginner", "intermediate", "expert"), "intermediate"),
    }
    sel = ",\n       ".join(f"{v[0]} AS {k}" for k, v in fields.items())
    valid = " AND ".join(v[1] for v in fields.values())
    q["extract_records"] = f"""
WITH {ANSWERS_CTE},
{parsed_cte('answers', 'event_id, text')}
SELECT event_id,
       {sel}
FROM parsed
WHERE json_type(j) = 'OBJECT'
  AND NOT coalesce({jt('is_financial')} = 'BOOLEAN' AND (j->>'$.is_financial') = 'false', false)
  AND {valid}"""
