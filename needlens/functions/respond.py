"""Model answers: prompt rendering (P9, P10), tolerant JSON parsing
and field rules of the structured answers (P12-P20, F3).

Answers are parsed to VARIANT, which keeps what a typed schema loses: a
missing key (SQL NULL), a JSON null (variant null), and the JSON type of
every value (``schema_of_variant``).  That is what the reference's rules test
(``raw.get(k) or default``, ``float(...)`` raising on null, enum membership
raising on a list), so the same rows are kept, defaulted or dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needlens.functions.text import strip

# The allowed enum values and their defaults for extracted
# needs, and the default text fields of the answers.
USER_TYPES = ("trader", "developer", "investor", "researcher", "casual")
EXPERIENCE_LEVELS = ("beginner", "intermediate", "expert")
NEED_TYPES = ("explicit", "implicit")
SENTIMENTS = ("positive", "negative", "neutral")
DEFAULT_USER_TYPE = "casual"
DEFAULT_LEVEL = "intermediate"
DEFAULT_NEED_TYPE = "implicit"
DEFAULT_SENTIMENT = "neutral"
DEFAULT_EMOTION = "neutral"
DEFAULT_ENTITY = "unknown"
DEFAULT_FEATURE = "unknown"
DEFAULT_INTENSITY = 0.5
EVIDENCE_CHARS = 60
DEFAULT_COVERAGE = "partial"
JSON_OPTIONS = {"allowUnquotedControlChars": "true"}
FIRST_JSON = r"(?s)(\{.*\}|\[.*\])"


# --- P9, P10 -----------------------------------------------------------------

def render(template: Column | str, values: Sequence[tuple[str, Column]]) -> Column:
    """Replace ``{key}`` literally, key by key in the given order; other
    braces stay.  A replaced value can be hit by a later key."""
    out = F.lit(template) if isinstance(template, str) else template
    for key, val in values:
        out = F.replace(out, F.lit("{" + key + "}"), F.coalesce(val.cast("string"), F.lit("None")))
    return out


def join_list(arr: Column, sep: str = ", ") -> Column:
    return F.coalesce(F.array_join(arr, sep), F.lit(""))


def bullets(arr: Column, n: int | None = None, prefix: str = "- ") -> Column:
    """``"\\n".join(f"- {t}" for t in arr[:n])``."""
    a = F.slice(arr, 1, n) if n else arr
    return F.coalesce(F.array_join(F.transform(a, lambda t: F.concat(F.lit(prefix), t)), "\n"), F.lit(""))


def quoted_lines(arr: Column) -> Column:
    """``"\\n".join(f'"{e}"' for e in arr)``."""
    return F.coalesce(F.array_join(F.transform(arr, lambda t: F.concat(F.lit('"'), t, F.lit('"'))), "\n"),
                      F.lit(""))


def python_list_text(arr: Column, n: int) -> Column:
    """``str(arr[:n])`` for a list of plain strings: ``['a', 'b']``."""
    items = F.transform(F.slice(arr, 1, n), lambda t: F.concat(F.lit("'"), t, F.lit("'")))
    return F.concat(F.lit("["), F.coalesce(F.array_join(items, ", "), F.lit("")), F.lit("]"))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


# --- P11 -----------------------------------------------------------------------

def parse_answers(df: DataFrame, raw_col: str, out_col: str = "answer_v") -> DataFrame:
    """Add ``out_col`` = VARIANT of the first parse that works: strict,
    then allowing raw control characters in strings, then the first
    ``{...}`` / ``[...]`` span (greedy).  NULL when nothing parses (the
    error case).  Code fences and ``\\'`` are removed first.

    Each step is its own column so no expression is inlined twice.
    """
    # removeprefix("```json"), removeprefix("```"), removesuffix("```"): anchored
    # replacements, each reading its input once (filters pushed through these
    # projections inline them, so repeated references would multiply)
    d = df.withColumn("_s1", F.regexp_replace(strip(F.col(raw_col)), r"\A(?:```json)?(?:```)?", ""))
    d = d.withColumn("_s5", F.replace(strip(F.regexp_replace("_s1", r"```\z", "")),
                                      F.lit("\\'"), F.lit("'")))
    d = d.withColumn("_span", F.regexp_extract("_s5", FIRST_JSON, 1))
    d = d.withColumn(out_col, F.coalesce(
        F.try_parse_json("_s5"),
        F.from_json("_s5", "variant", JSON_OPTIONS),
        F.when(F.col("_span") != "", F.from_json("_span", "variant", JSON_OPTIONS))))
    return d.drop("_s1", "_s5", "_span")


# --- variant field tests -----------------------------------------------------------

class Field:
    """A field of a parsed answer: its VARIANT value ``v`` (SQL NULL when the
    key is missing) and JSON type ``t`` (``schema_of_variant``), both
    materialised columns."""

    def __init__(self, v: Column, t: Column):
        self.v, self.t = v, t


def extract_fields(df: DataFrame, v_col: str, names: Sequence[str], prefix: str = "_f") -> DataFrame:
    """Add ``{prefix}_{name}`` (variant) and ``{prefix}t_{name}`` (type) columns."""
    d = df
    for n in names:
        d = d.withColumn(f"{prefix}_{n}", F.try_variant_get(F.col(v_col), f"$.{n}", "variant"))
    d = d.withColumn(f"{prefix}t__obj", F.schema_of_variant(F.col(v_col)))
    for n in names:
        d = d.withColumn(f"{prefix}t_{n}", F.schema_of_variant(F.col(f"{prefix}_{n}")))
    return d


def fld(name: str, prefix: str = "_f") -> Field:
    return Field(F.col(f"{prefix}_{name}"), F.col(f"{prefix}t_{name}"))


def is_object_type(t: Column) -> Column:
    return F.coalesce(F.startswith(t, F.lit("OBJECT")), F.lit(False))


def is_missing(f: Field) -> Column:
    return f.v.isNull()


def is_json_null(f: Field) -> Column:
    return F.coalesce(f.t == "VOID", F.lit(False))


def is_string(f: Field) -> Column:
    return F.coalesce(f.t == "STRING", F.lit(False))


def is_bool(f: Field) -> Column:
    return F.coalesce(f.t == "BOOLEAN", F.lit(False))


def is_number(f: Field) -> Column:
    return F.coalesce(f.t.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
                      | F.startswith(f.t, F.lit("DECIMAL")), F.lit(False))


def is_container(f: Field) -> Column:
    return F.coalesce(F.startswith(f.t, F.lit("ARRAY")) | F.startswith(f.t, F.lit("OBJECT")), F.lit(False))


def as_string(f: Field) -> Column:
    return F.when(is_string(f), F.try_variant_get(f.v, "$", "string"))


def is_falsy(f: Field) -> Column:
    """Python truthiness of a JSON value: missing, null, false, 0, "", [], {}."""
    return (is_missing(f) | is_json_null(f)
            | (is_bool(f) & ~F.coalesce(F.try_variant_get(f.v, "$", "boolean"), F.lit(True)))
            | (is_number(f) & (F.try_variant_get(f.v, "$", "double") == 0))
            | (is_string(f) & (as_string(f) == ""))
            | F.coalesce(f.t.isin("ARRAY<VOID>", "OBJECT<>"), F.lit(False)))


def text_or(f: Field, default: Column | str) -> tuple[Column, Column]:
    """``raw.get(k) or default`` into a text field: (value, valid).  A truthy
    value that is not text makes the record invalid."""
    d = F.lit(default) if isinstance(default, str) else default
    falsy = is_falsy(f)
    return F.when(falsy, d).otherwise(as_string(f)), falsy | is_string(f)


def optional_text(f: Field) -> tuple[Column, Column]:
    """Optional text passed as is: missing/null -> NULL; other types invalid."""
    return as_string(f), is_missing(f) | is_json_null(f) | is_string(f)


def enum_or(f: Field, allowed: Sequence[str], default: str) -> tuple[Column, Column]:
    """Value if in ``allowed`` else default; a list or object raises in
    the reference (unhashable), so it makes the record invalid."""
    s = as_string(f)
    return F.when(s.isin(*allowed), s).otherwise(F.lit(default)), ~is_container(f)


def _number(f: Field) -> Column:
    return (F.when(is_bool(f), F.try_variant_get(f.v, "$", "boolean").cast("double"))
             .when(is_number(f), F.try_variant_get(f.v, "$", "double"))
             .when(is_string(f), F.trim(as_string(f)).try_cast("double")))


def clamp_number(f: Field, default: float) -> tuple[Column, Column]:
    """``max(0, min(1, float(x)))``; missing -> default; null, lists,
    objects and unparsable text invalid; true/false -> 1/0; NaN -> 1."""
    num = _number(f)
    val = F.when(is_missing(f), F.lit(default)).otherwise(num)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), val)), is_missing(f) | num.isNotNull()


def number_or(f: Field, default: Column) -> tuple[Column, Column]:
    """P20: ``float(raw.get(k, default))`` without clamping."""
    num = _number(f)
    return F.when(is_missing(f), default).otherwise(num), is_missing(f) | num.isNotNull()


def json_false(f: Field) -> Column:
    """true only for the JSON value ``false`` (missing/null/text keep)."""
    return is_bool(f) & ~F.coalesce(F.try_variant_get(f.v, "$", "boolean"), F.lit(True))


def flag_or(f: Field, default: bool = False) -> Column:
    """P20 with the text fix: JSON booleans as is, "true"/"false" text parsed,
    numbers by truthiness, missing -> default."""
    s = F.lower(F.trim(as_string(f)))
    return (F.when(is_bool(f), F.try_variant_get(f.v, "$", "boolean"))
             .when(is_string(f), s.isin("true", "yes", "1"))
             .when(is_number(f), F.try_variant_get(f.v, "$", "double") != 0)
             .otherwise(F.lit(default)))


NEED_FIELDS = ("is_financial", "entity", "feature", "opinion", "need_type", "pain_point",
               "root_cause", "sentiment", "emotion", "intensity", "evidence", "user_type",
               "experience_level")


def need_records(df: DataFrame, v_col: str, text_col: str, out_col: str = "rec") -> DataFrame:
    """P12-P16 + F3 for extraction answers parsed into ``v_col``.

    Adds ``out_col = struct<keep, skipped, fields...>``: ``skipped`` marks the
    off-domain answers (``is_financial`` false), ``keep`` the valid records.
    """
    d = extract_fields(df, v_col, NEED_FIELDS)
    obj = is_object_type(F.col("_ft__obj"))
    entity, ok1 = text_or(fld("entity"), DEFAULT_ENTITY)
    feature, ok2 = text_or(fld("feature"), DEFAULT_FEATURE)
    opinion, ok3 = text_or(fld("opinion"), "")
    need_type, ok4 = enum_or(fld("need_type"), NEED_TYPES, DEFAULT_NEED_TYPE)
    pain, ok5 = optional_text(fld("pain_point"))
    root, ok6 = optional_text(fld("root_cause"))
    sentiment, ok7 = enum_or(fld("sentiment"), SENTIMENTS, DEFAULT_SENTIMENT)
    emotion, ok8 = text_or(fld("emotion"), DEFAULT_EMOTION)
    intensity, ok9 = clamp_number(fld("intensity"), DEFAULT_INTENSITY)
    evidence, ok10 = text_or(fld("evidence"), F.substring(F.col(text_col), 1, EVIDENCE_CHARS))
    user_type, ok11 = enum_or(fld("user_type"), USER_TYPES, DEFAULT_USER_TYPE)
    level, ok12 = enum_or(fld("experience_level"), EXPERIENCE_LEVELS, DEFAULT_LEVEL)
    skipped = obj & json_false(fld("is_financial"))
    valid = obj & ok1 & ok2 & ok3 & ok4 & ok5 & ok6 & ok7 & ok8 & ok9 & ok10 & ok11 & ok12
    rec = F.struct(
        F.coalesce(valid & ~skipped, F.lit(False)).alias("keep"),
        F.coalesce(skipped, F.lit(False)).alias("skipped"),
        entity.alias("entity"), feature.alias("feature"), opinion.alias("opinion"),
        need_type.alias("need_type"), pain.alias("pain_point"), root.alias("root_cause"),
        sentiment.alias("sentiment"), emotion.alias("emotion"), intensity.alias("intensity"),
        evidence.alias("evidence"), user_type.alias("user_type"),
        level.alias("experience_level"))
    tmp = [c for c in d.columns if c.startswith("_f")]
    return d.withColumn(out_col, rec).drop(*tmp)


def cluster_names(df: DataFrame, v_col: str, id_col: str) -> DataFrame:
    """Add ``cluster_name`` (default ``Cluster {id}``) and ``description``
    (default ""); a failed answer or a non-object gives the defaults."""
    d = extract_fields(df, v_col, ("name", "description"), "_g")
    obj = is_object_type(F.col("_gt__obj"))
    name = F.when(obj & is_string(fld("name", "_g")), as_string(fld("name", "_g")))
    desc = F.when(obj & is_string(fld("description", "_g")), as_string(fld("description", "_g")))
    d = d.withColumn("cluster_name", F.coalesce(name, F.concat(F.lit("Cluster "), F.col(id_col).cast("string"))))
    d = d.withColumn("description", F.coalesce(desc, F.lit("")))
    return d.drop(*[c for c in d.columns if c.startswith("_g")])


def _solution_items(v: Column) -> Column:
    arr = F.when(is_object_type(F.schema_of_variant(v)),
                 F.try_variant_get(v, "$.solutions", "array<variant>"))
    return F.coalesce(arr, F.array().cast("array<variant>"))


def solutions_readable(v: Column) -> Column:
    """Every entry is an object; the cluster is left out otherwise."""
    return F.forall(_solution_items(v), lambda s: F.coalesce(is_object_type(F.schema_of_variant(s)), F.lit(False)))


def solutions(v: Column) -> Column:
    """``array<struct<name, coverage, limitation>>``; missing -> []."""
    items = _solution_items(v)
    return F.transform(items, lambda s: F.struct(
        F.coalesce(F.try_variant_get(s, "$.name", "string"), F.lit("")).alias("name"),
        F.coalesce(F.try_variant_get(s, "$.coverage", "string"), F.lit(DEFAULT_COVERAGE)).alias("coverage"),
        F.coalesce(F.try_variant_get(s, "$.limitation", "string"), F.lit("")).alias("limitation")))
