"""K1-K4, R1-R2, W1, W6, O1/O2 and the distributed row number."""

import datetime as dt

from pyspark.sql import functions as F

from needlens.operators.dedup import first_wins
from needlens.operators.ranking import global_row_number, top_n
from needlens.operators.results import (cache_key, delete_keys, get_fresh, misses, purge_expired, puts,
                                        run_state)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _table(spark, writes):
    df = spark.createDataFrame(writes, "ns string, part string, value string, at timestamp, ttl int, seq long")
    return puts(df, cache_key(F.col("ns"), [F.col("part")]), F.col("value"), F.col("at"), F.col("ttl"), F.col("seq"))


def test_cache_key_digest(spark):
    import hashlib
    df = spark.createDataFrame([("posts", "bitcoin")], "ns string, p string")
    got = df.select(cache_key(F.col("ns"), [F.col("p")])).first()[0]
    assert got == hashlib.sha256(b"posts:bitcoin").hexdigest()


def test_last_write_wins_and_ttl(spark):
    t = _table(spark, [("ns", "a", "v1", T0, 24, 1), ("ns", "a", "v2", T0 + dt.timedelta(hours=1), 24, 2),
                       ("ns", "b", "x", T0, 0, 3)])
    now = F.lit(T0 + dt.timedelta(hours=2))
    fresh = {r["value"] for r in get_fresh(t, now).collect()}
    assert fresh == {"v2"}  # b expired (TTL 0)


def test_purge_and_delete(spark):
    t = _table(spark, [("ns", "a", "keep", T0, 24, 1), ("ns", "b", "gone", T0, 0, 2)])
    now = F.lit(T0 + dt.timedelta(hours=1))
    assert {r["value"] for r in purge_expired(t, now).collect()} == {"keep"}
    keys = t.where("value = 'keep'").select("cache_key")
    assert {r["value"] for r in delete_keys(t, keys).collect()} == {"gone"}


def test_misses_only_for_stale_keys(spark):
    t = _table(spark, [("ns", "a", "v", T0, 24, 1)])
    req = spark.createDataFrame([("ns", "a"), ("ns", "z")], "ns string, part string").select(
        cache_key(F.col("ns"), [F.col("part")]).alias("cache_key"), "part")
    got = {r["part"] for r in misses(req, get_fresh(t, F.lit(T0 + dt.timedelta(hours=1)))).collect()}
    assert got == {"z"}


def test_run_state_resubmission_resets(spark):
    ev = spark.createDataFrame([
        ("r1", "pending", T0, 1), ("r1", "running", T0 + dt.timedelta(minutes=1), 2),
        ("r1", "completed", T0 + dt.timedelta(minutes=2), 3), ("r1", "pending", T0 + dt.timedelta(minutes=5), 4),
        ("r2", "pending", T0, 5), ("r2", "failed", T0 + dt.timedelta(minutes=3), 6)],
        "run_id string, status string, ts timestamp, seq long")
    got = {r["run_id"]: r for r in run_state(ev).collect()}
    assert got["r1"]["status"] == "pending" and got["r1"]["completed_at"] is None
    assert got["r1"]["created_at"] == T0 + dt.timedelta(minutes=5)
    assert got["r2"]["status"] == "failed" and got["r2"]["completed_at"] == T0 + dt.timedelta(minutes=3)


def test_first_wins_keeps_earliest(spark):
    df = spark.createDataFrame([("p1", "topic_b", 5), ("p1", "topic_a", 2), ("p2", "topic_a", 3)],
                               "post_id string, topic string, ord long")
    got = sorted((r["post_id"], r["topic"]) for r in first_wins(df, ["post_id"], ["ord"]).collect())
    assert got == [("p1", "topic_a"), ("p2", "topic_a")]


def test_global_row_number_matches_sort(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id"))
    out = global_row_number(df, ["k", "id"], [False, True], "rank", n_partitions=5)
    got = [r["k"] for r in out.orderBy("rank").collect()]
    assert got == sorted(got, reverse=True) and out.agg(F.max("rank")).first()[0] == 1000


def test_global_row_number_fits_its_partitions_to_the_data(spark):
    """A handful of rows is not dealt over every shuffle partition of a large session."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.createDataFrame([(None,), (3,), (1,), (2,), (2,)], "k int").repartition(3, "k")
        out = global_row_number(df, ["k"], [False], "rank")
        assert [r["k"] for r in out.orderBy("rank").collect()] == [3, 2, 2, 1, None]
        assert sorted(r["rank"] for r in out.collect()) == [1, 2, 3, 4, 5]
        none = global_row_number(df.where("k > 9"), ["k"], [True], "rank")
        assert none.collect() == [] and none.columns == ["k", "rank"]
        wide = global_row_number(spark.range(0, 100000, 1, 16).select((F.col("id") * 7919 % 100000).alias("k")), ["k"], [True], "rank")
        assert wide.where("rank != k + 1").isEmpty() and wide.rdd.getNumPartitions() < 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_global_row_number_is_a_projection_of_a_stage_table(spark):
    """Counts of partitions without rows, and VARIANT columns, are carried; the result has no window, join or RDD."""
    df = spark.createDataFrame([(x, '{"a": %d}' % x) for x in (5, 1, 9, 3)], "k int, doc string").select("k", F.parse_json("doc").alias("doc"))
    out = global_row_number(df, ["k"], [True], "rank", n_partitions=8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Window", "Join", "LogicalRDD")) and "parquet" in plan
    got = out.select("rank", "k", F.try_variant_get("doc", "$.a", "int").alias("a")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (2, 3, 3), (3, 5, 5), (4, 9, 9)]


def test_top_n_stable(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "first_ord long, score double")
    got = [(r["rank"], r["first_ord"]) for r in top_n(df, [F.desc("score"), F.asc("first_ord")], 3).collect()]
    assert sorted(got) == [(1, 2), (2, 5), (3, 8)]
