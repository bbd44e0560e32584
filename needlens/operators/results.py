"""Keyed results with expiry (K1-K4) and run history.

Re-aimed from a single-file key/value store: the table is append-only, a
``put`` appends ``(key, value, written_at, expires, seq)``, readers take the
latest row per key (W6, a combinable ``max_by``) and check expiry.  Purge is
a filter whose output is written to a new table version by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needlens.operators.dedup import latest_per_key

# Default time to live of a result, in hours.
DEFAULT_TTL_HOURS = 24


def cache_key(namespace: Column, parts: Sequence[Column]) -> Column:
    """SHA-256 hex of ``namespace:part:part...``."""
    if not parts:
        return F.sha2(F.concat(namespace, F.lit(":")), 256)
    return F.sha2(F.concat_ws(":", namespace, *[p.cast("string") for p in parts]), 256)


def puts(df: DataFrame, key: Column, value: Column, written_at: Column,
         ttl_hours: Column | None = None, seq: Column | None = None) -> DataFrame:
    """K1: rows to append for the given writes."""
    ttl = ttl_hours if ttl_hours is not None else F.lit(DEFAULT_TTL_HOURS)
    return df.select(key.alias("cache_key"), value.alias("value"),
                     written_at.alias("written_at"),
                     (written_at + F.make_interval(hours=ttl.cast("int"))).alias("expires"),
                     (seq if seq is not None else F.lit(0)).cast("long").alias("seq"))


def latest(table: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Last write per key (ties by ``seq``); with ``as_of`` only writes made
    at or before that time count."""
    if as_of is not None:
        table = table.filter(F.col("written_at") <= as_of)
    return latest_per_key(table, ["cache_key"], ["written_at", "seq"])


def get_fresh(table: DataFrame, now: Column) -> DataFrame:
    """K2: the current value of each key whose last write has not expired."""
    return latest(table, now).filter(F.col("expires") >= now)


def purge_expired(table: DataFrame, now: Column) -> DataFrame:
    """K3: rows that are still valid at ``now``."""
    return table.filter(F.col("expires") >= now)


def delete_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    """K3: drop every row of the given keys."""
    return table.join(keys.select("cache_key").distinct(), "cache_key", "left_anti")


def misses(requested: DataFrame, fresh: DataFrame) -> DataFrame:
    """Requested keys without a fresh result (the only ones to compute)."""
    return requested.join(fresh.select("cache_key"), "cache_key", "left_anti")


def hits(requested: DataFrame, fresh: DataFrame) -> DataFrame:
    """Requested keys served from stored results."""
    return requested.join(fresh, "cache_key", "inner")


def stored_or_fetched(requested: DataFrame, fresh: DataFrame, fetched: DataFrame) -> DataFrame:
    """One value per requested key: the fresh stored one, else the row of
    ``fetched`` (null without one).  ``stored`` tells where it comes from."""
    kept = hits(requested, fresh.select("cache_key", "value")).withColumn("stored", F.lit(True))
    new = misses(requested, fresh).join(fetched.select("cache_key", "value"), "cache_key", "left")
    return kept.unionByName(new.withColumn("stored", F.lit(False)))


# Run states of the run history.
PENDING, RUNNING, COMPLETED, FAILED = "pending", "running", "completed", "failed"


def run_state(events: DataFrame, run_id: str = "run_id", status: str = "status",
              ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Current row per run from append-only status events.

    A ``pending`` event (a new submission) starts a new attempt: ``created_at``
    is the time of the last one (the first event when there is none);
    ``completed_at`` is the time of the last event when the run ended.
    """
    agg = events.groupBy(run_id).agg(
        F.max_by(F.struct(F.col(status).alias("status"), F.col(ts).alias("updated_at")),
                 F.struct(F.col(ts), F.col(seq))).alias("_last"),
        F.max(F.when(F.col(status) == PENDING, F.col(ts))).alias("_last_pending"),
        F.min(F.col(ts)).alias("_first"),
    )
    return agg.select(
        run_id,
        F.col("_last.status").alias("status"),
        F.coalesce("_last_pending", "_first").alias("created_at"),
        F.col("_last.updated_at").alias("updated_at"),
        F.when(F.col("_last.status").isin(COMPLETED, FAILED), F.col("_last.updated_at"))
         .alias("completed_at"),
    )
