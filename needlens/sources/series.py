"""Topic time series (S5) and topic velocity, derived from timestamped rows.

Both aggregate first (one row per topic and day, combinable), so the windows
that follow run on a table bounded by topics x days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_series(rows: DataFrame, days: int = 14) -> DataFrame:
    """``rows(topic, ts, sentiment, interactions)`` -> one row per topic and
    day within the last ``days`` days of that topic:
    ``topic, day, n_events, avg_sentiment, interactions``."""
    daily = (rows.groupBy("topic", F.to_date("ts").alias("day"))
                 .agg(F.count(F.lit(1)).alias("n_events"),
                      F.avg("sentiment").alias("avg_sentiment"),
                      F.sum("interactions").alias("interactions")))
    last = F.max("day").over(Window.partitionBy("topic"))
    return (daily.withColumn("_last", last)
                 .filter(F.col("day") > F.date_sub(F.col("_last"), days))
                 .drop("_last"))


def topic_velocity(rows: DataFrame, window_days: int = 7) -> DataFrame:
    """Relative change of the row count: last ``window_days`` days of the
    topic vs the ``window_days`` before (null when the earlier count is 0):
    ``topic, recent, prior, velocity``."""
    daily = rows.groupBy("topic", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    daily = daily.withColumn("_last", F.max("day").over(Window.partitionBy("topic")))
    age = F.datediff(F.col("_last"), F.col("day"))
    agg = daily.groupBy("topic").agg(
        F.coalesce(F.sum(F.when(age < window_days, F.col("n"))), F.lit(0)).alias("recent"),
        F.coalesce(F.sum(F.when((age >= window_days) & (age < 2 * window_days), F.col("n"))),
                   F.lit(0)).alias("prior"))
    return agg.withColumn(
        "velocity", F.when(F.col("prior") > 0,
                           (F.col("recent") - F.col("prior")) / F.col("prior")))
