"""Ranking (O1, O2, W7) and a distributed global row number.

A global ``row_number()`` window moves every row into one task.  Instead
``global_row_number`` sorts (Spark's own range-partitioned sort, with as many
partitions as the data needs), takes partition and position inside it from
``monotonically_increasing_id`` (partition number in the upper bits, consecutive
within a partition), and adds the row count of all earlier partitions.  The sorted
table is written as a stage table, so that the counts and every reader see the same
partitioning, also after an executor loss; the counts, one number a partition, are the
one thing read on the driver, and become a literal.  The result is then a plain
projection of the stage table: no checkpointed RDD, window or join.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from needlens.operators.scratch import Scratch


def global_row_number(df: DataFrame, keys: Sequence[str], ascending: Sequence[bool],
                      rank_col: str = "rank", n_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1..n in the order of ``keys`` (nulls first when
    ascending, last when descending); keys should identify rows uniquely."""
    sort_exprs = [F.col(k).asc() if a else F.col(k).desc() for k, a in zip(keys, ascending)]
    if n_partitions:
        ordered = df.repartitionByRange(n_partitions, *sort_exprs).sortWithinPartitions(*sort_exprs)
    else:
        ordered = df.orderBy(*sort_exprs)
    ordered = Scratch(df.sparkSession, "numbers").keep(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    pid, local = F.shiftright("_at", 33).cast("int"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {r["_pid"]: r["_cnt"] for r in ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt")).collect()}
    before = [0, *accumulate(counts.get(k, 0) for k in range(max(counts, default=0)))]
    out = ordered.withColumn(rank_col, F.get(F.lit(before).cast("array<bigint>"), pid) + local + 1)
    return out.drop("_at")


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """O2 + W7: the first ``n`` rows in ``order`` with their rank.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject (a per-task top-n,
    then a merge of n rows per task); the rank window then runs on n rows.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
