"""User segments (D3) and topic merging (D4) with ``pyspark.ml`` KMeans.

* D3: per user, the share of each value (e.g. topic or event type) among the
  user's rows -> KMeans with k segments.
* D4: merge clusters down to at most N topics by clustering the cluster
  centroids (weighted by cluster size) with KMeans(k = N): an all-pairs merge
  loop is replaced by a distributed clustering of the (small) centroid table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Number of user segments and the seed.
USER_SEGMENTS = 5
SEED = 42


def user_shares(rows: DataFrame, user: str, value: str, values: list[str]) -> DataFrame:
    """``user, shares array<double>`` in the order of ``values``."""
    counts = rows.groupBy(user).pivot(value, values).count().na.fill(0)
    total = sum(F.col(v) for v in values)
    return counts.select(user, F.array(*[(F.col(v) / total).cast("double") for v in values]).alias("shares"))


def kmeans_segments(df: DataFrame, vec_col: str, k: int = USER_SEGMENTS, seed: int = SEED,
                    out_col: str = "segment", weight_col: str | None = None) -> DataFrame:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = df.withColumn("_v", array_to_vector(F.col(vec_col)))
    n = v.count()
    km = KMeans(k=max(1, min(k, n)), seed=seed, featuresCol="_v", predictionCol=out_col)
    if weight_col:
        km = km.setWeightCol(weight_col)
    return km.fit(v).transform(v).drop("_v")


def merge_topics(centroids: DataFrame, cluster: str, n_topics: int, seed: int = SEED) -> DataFrame:
    """``cluster, merged_topic`` for a centroid table
    ``(cluster, centroid array<double>, n_points)``."""
    merged = kmeans_segments(centroids.withColumn("_w", F.col("n_points").cast("double")), "centroid",
                             n_topics, seed, "merged_topic", "_w")
    return merged.select(cluster, "merged_topic")
