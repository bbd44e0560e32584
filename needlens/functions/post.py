"""Per-post field rules of the feed readers (P2-P8) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default timestamp for a missing/zero epoch, default raw
# sentiment (0-5 scale) and its rescale factor to 0-100.
DEFAULT_TS_SQL = "2024-01-01 00:00:00"
DEFAULT_TS_TEXT = "2024-01-01T00:00:00"
DEFAULT_SENTIMENT_RAW = 2.5
SENTIMENT_SCALE = 20.0
DEFAULT_SENTIMENT_B = 50.0


def default_ts() -> Column:
    return F.lit(DEFAULT_TS_SQL).cast("timestamp")


def network(post_type: Column) -> Column:
    """Missing -> ``unknown``; remove every ``-post``, then ``-`` -> ``_``."""
    pt = F.coalesce(post_type, F.lit("unknown"))
    return F.replace(F.replace(pt, F.lit("-post"), F.lit("")), F.lit("-"), F.lit("_"))


def network_b(network_col: Column, post_type: Column) -> Column:
    """``network`` if non-empty, else ``post_type`` up to the first ``-``."""
    pt = F.coalesce(post_type, F.lit("unknown"))
    return F.coalesce(F.nullif(network_col, F.lit("")), F.split_part(pt, F.lit("-"), F.lit(1)))


def epoch_timestamp(epoch: Column) -> Column:
    """Epoch seconds; 0 / null -> 2024-01-01."""
    e = epoch.cast("long")
    return F.when(e.isNull() | (e == 0), default_ts()).otherwise(F.timestamp_seconds(e))


def any_timestamp(*cands: Column) -> Column:
    """First present of the candidates; numbers are epoch seconds,
    text is ISO time; none -> 2024-01-01T00:00:00."""
    first = F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cands],
                       F.lit(DEFAULT_TS_TEXT))
    as_num = first.try_cast("double")
    return F.when(as_num.isNotNull(), F.timestamp_seconds(as_num.cast("long"))).otherwise(
        F.try_to_timestamp(first))


def sentiment_rescale(raw: Column) -> Column:
    """``float(x or 2.5) * 20``; a numeric 0 is falsy, so 0 -> 50."""
    r = raw.cast("double")
    return F.coalesce(F.nullif(r, F.lit(0.0)), F.lit(DEFAULT_SENTIMENT_RAW)) * F.lit(SENTIMENT_SCALE)


def sentiment_b(*cands: Column) -> Column:
    """``post_sentiment or sentiment or 50.0``, no rescale."""
    return F.coalesce(*[F.nullif(c.cast("double"), F.lit(0.0)) for c in cands],
                      F.lit(DEFAULT_SENTIMENT_B))


def interactions(*cands: Column) -> Column:
    """P5: first non-zero of the candidates, else 0."""
    return F.coalesce(*[F.nullif(c.cast("long"), F.lit(0)) for c in cands], F.lit(0).cast("long"))


def id_text(c: Column) -> Column:
    """Identifiers as text; missing and null both give ""."""
    return F.coalesce(c.cast("string"), F.lit(""))


def first_text(*cands: Column) -> Column:
    """First non-empty text of the candidates, else ""."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cands], F.lit(""))
