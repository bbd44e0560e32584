"""Fallback chains (P1b, P3b, P4b), J4 hits, L2 metrics, series trend, replication."""

import datetime as dt

from pyspark.sql import functions as F

from needlens.functions import post as P


def test_first_text_and_sentiment_b(spark):
    df = spark.createDataFrame([("", "t", None), (None, "", "title")], "a string, b string, c string")
    assert [r[0] for r in df.select(P.first_text(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["t", "title"]
    s = spark.createDataFrame([(0.0, 3.0), (None, None), (4.0, 1.0)], "a double, b double")
    assert [r[0] for r in s.select(P.sentiment_b(F.col("a"), F.col("b"))).collect()] == [3.0, 50.0, 4.0]


def test_any_timestamp(spark):
    df = spark.createDataFrame([("1705312800", None), (None, "2024-02-01T10:00:00"), (None, None)],
                               "a string, b string")
    got = [str(r[0]) for r in df.select(P.any_timestamp(F.col("a"), F.col("b"))).collect()]
    assert got == ["2024-01-15 10:00:00", "2024-02-01 10:00:00", "2024-01-01 00:00:00"]


def test_hits_serve_stored_values(spark):
    from needlens.operators.results import cache_key, get_fresh, hits, puts
    t0 = dt.datetime(2024, 1, 1)
    w = spark.createDataFrame([("ns", "a", "va", t0, 24, 1)], "ns string, p string, v string, at timestamp, ttl int, s long")
    table = puts(w, cache_key(F.col("ns"), [F.col("p")]), F.col("v"), F.col("at"), F.col("ttl"), F.col("s"))
    req = spark.createDataFrame([("ns", "a"), ("ns", "b")], "ns string, p string").select(
        cache_key(F.col("ns"), [F.col("p")]).alias("cache_key"), "p")
    got = [(r["p"], r["value"]) for r in hits(req, get_fresh(table, F.lit(t0 + dt.timedelta(hours=1)))).collect()]
    assert got == [("a", "va")]


def test_l2_metrics_count_skips_and_errors(spark):
    from needlens.plans.needs import extract_needs, l2_metrics
    posts = spark.createDataFrame(
        [(str(i), t, i, None, "btc", None, None) for i, t in enumerate(["about money", "about food", "no answer", "money again"])],
        "post_id string, text string, ord long, timestamp timestamp, topic string, topic_label string, "
        "topic_keywords array<string>")

    def answer(prompts):
        texts = [p.split("Post:\n")[1] for p in prompts]
        return ["none" if t == "no answer" else '{"is_financial": %s}' % str("money" in t).lower() for t in texts]
    m = l2_metrics(extract_needs(posts, answer)).first()
    assert (m["records"], m["skipped_off_domain"], m["errors"]) == (2, 1, 1)


def test_global_trend_series_form(spark):
    from needlens.plans.needs import global_trend
    pts = spark.createDataFrame([("a", 0, 40.0), ("a", 1, 45.0), ("b", 0, 50.0), ("b", 1, 60.0), ("b", 2, 0.0)],
                                "topic string, ord int, sentiment double")
    assert global_trend(series=pts) == "rising"
    assert global_trend() == "stable"


def test_replication_factor_is_small_on_blobs(spark):
    import random
    from needlens.operators.neighbors import replication_factor
    rnd = random.Random(1)
    pts = [[10.0 * c + rnd.gauss(0, 0.2) for _ in range(6)] for c in range(4) for _ in range(50)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "id long, v array<double>")
    # full replication would send every point to all 8 pivots
    assert 1.0 <= replication_factor(df, "id", "v", 0.5, n_pivots=8) < 8 / 2
