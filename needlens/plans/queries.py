"""Driver queries: one per operator family, each over whole tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching SQL in ``needlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needlens.functions import post as P
from needlens.functions import text as T
from needlens.operators.ctfidf import ctfidf_keywords
from needlens.operators.dedup import first_wins
from needlens.plans.collect import collect
from needlens.sources.posts import posts_from_documents
from needlens.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def clean_posts(spark, sf_dir):
    """P1, P2, F1, F2 on documents."""
    docs = load(spark, sf_dir, "documents")
    t = T.strip(F.col("text"))
    return (docs.select(F.col("doc_id").cast("string").alias("post_id"),
                        P.network(F.col("source")).alias("network"),
                        t.alias("text"))
                .filter(T.long_enough(F.col("text")) & T.is_latin(F.col("text")))
                .select("post_id", "network", F.char_length("text").alias("n_chars"), "text"))


@query
def latin_ratio(spark, sf_dir):
    """F2 letter counts per document."""
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id",
                       T.n_letters(F.col("text")).alias("n_letters"),
                       T.n_ascii_letters(F.col("text")).alias("n_ascii_letters"),
                       T.is_latin(F.col("text")).alias("is_latin"))


@query
def dedup_first(spark, sf_dir):
    """First document (by doc_id) of every distinct stripped text."""
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(T.strip(F.col("text")), 256).alias("text_hash"))
    return first_wins(docs, ["text_hash"], ["doc_id"], count_col="n_copies")


@query
def ctfidf_keywords_by_source(spark, sf_dir):
    """P1, F1, F2, W1 then C6 keywords per source (the minimum slice)."""
    from needlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # L0 output is a stage table: the cluster count and the term counts read it once each
    posts = collect(posts_from_documents(load(spark, sf_dir, "documents")), key="text").checkpoint(eager=True)
    kw = ctfidf_keywords(posts, "topic", "text")
    return kw.select(F.col("cluster").alias("source"), "rank", "term", "tf", "cf",
                     F.round("score", 9).alias("score"))


# --- post field rules (P2-P5, P8) -------------------------------------------

@query
def sentiment_rescale(spark, sf_dir):
    """P3, P4, P5 on events read as raw posts.

    raw sentiment (0-5) = floor(value / 10) / 10, so some raw values are 0
    and fall back to 2.5; interactions = props.k, else user_id, else 0.
    """
    ev = load(spark, sf_dir, "events")
    raw = F.floor(F.col("value") / 10) / 10
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(F.col("event_id").cast("string").alias("post_id"),
                     P.sentiment_rescale(raw).alias("sentiment_lc"),
                     P.interactions(k, F.col("user_id")).alias("interactions"),
                     P.epoch_timestamp(F.unix_seconds(F.col("ts").cast("timestamp")))
                     .cast("timestamp_ntz").alias("timestamp"))


@query
def network_norm(spark, sf_dir):
    """P2 and P2b on a post type built as ``<lang>-<source>-post``."""
    docs = load(spark, sf_dir, "documents")
    pt = F.concat_ws("-", "lang", "source", F.lit("post"))
    return docs.select("doc_id", pt.alias("post_type"),
                       P.network(pt).alias("network"),
                       P.network_b(F.lit(""), pt).alias("network_b"))


@query
def topic_norm(spark, sf_dir):
    """P8 + S3: normalised topic names and the first document per name."""
    docs = load(spark, sf_dir, "documents")
    raw = F.concat(F.upper("lang"), F.lit("_"), F.col("source"), F.lit("-Feed "))
    named = docs.select("doc_id", raw.alias("topic"), T.normalize_topic(raw).alias("topic_norm"))
    return first_wins(named, ["topic_norm"], ["doc_id"], count_col="n_docs")


# --- profiles (A4-A9, C9-C11, O1-O2) ----------------------------------------

def _order_records(spark, sf_dir):
    """orders joined to their customer as need records: nation = cluster,
    market segment = user type, order priority -> experience level."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                             "o_orderstatus")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    level = (F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("expert"))
              .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("intermediate"))
              .otherwise(F.lit("beginner")))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("need_cluster_id"),
        F.lower("c_mktsegment").alias("user_type"),
        level.alias("experience_level"),
        F.col("o_orderpriority").alias("root_cause"),
        F.col("o_orderstatus").alias("source_topic"),
        F.col("o_orderkey").alias("ord"))


def _event_records(spark, sf_dir):
    """events as need records: intensity = value / 100 clamped to [0, 1]."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "user_id", "event_type", "ts", "value",
        F.col("event_type").alias("emotion"),
        F.least(F.greatest(F.col("value") / 100, F.lit(0.0)), F.lit(1.0)).alias("intensity"),
        F.col("event_id").alias("ord"))


@query
def personas(spark, sf_dir):
    from needlens.operators.profile import personas as build
    return build(_order_records(spark, sf_dir))


@query
def emotion_profile(spark, sf_dir):
    from needlens.operators.profile import emotion_rows
    recs = _event_records(spark, sf_dir).withColumn("need_cluster_id", F.col("user_id") % 10)
    rows = emotion_rows(recs)
    return rows.withColumn("mean_intensity", F.round("mean_intensity", 9))


def _daily(spark, sf_dir):
    """Daily series per topic (event type) over the last 14 days of the topic."""
    from needlens.sources.series import daily_series
    ev = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), "ts",
        F.col("value").alias("sentiment"),
        F.get_json_object("props", "$.k").cast("long").alias("interactions"))
    return daily_series(ev, days=14)


@query
def daily_series(spark, sf_dir):
    return _daily(spark, sf_dir).withColumn("avg_sentiment", F.round("avg_sentiment", 9))


@query
def trend_series(spark, sf_dir):
    """W5 + C11 per topic, plus the concatenated series of all topics ('*')."""
    from needlens.operators.profile import series_trend
    d = _daily(spark, sf_dir)
    pts = d.select(F.col("topic").alias("series"), "topic", "day", "avg_sentiment").unionByName(
        d.select(F.lit("*").alias("series"), "topic", "day", "avg_sentiment"))
    out = series_trend(pts, "series", ["topic", "day"], "avg_sentiment")
    return out.select(F.col("series").alias("topic"), "n_points",
                      F.round("diff", 9).alias("diff"), "trend")


def _velocity(spark, sf_dir):
    from needlens.sources.series import topic_velocity
    ev = load(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), "ts")
    return topic_velocity(ev, window_days=7)


@query
def trend_velocity(spark, sf_dir):
    """A9 + C11 state form: per-topic velocity, and their unweighted mean ('*')."""
    from needlens.functions.score import trend_from_velocity
    v = _velocity(spark, sf_dir)
    per_topic = v.select("topic", "recent", "prior", "velocity")
    overall = v.agg(F.coalesce(F.avg(F.coalesce("velocity", F.lit(0.0))), F.lit(0.0)).alias("velocity")) \
               .select(F.lit("*").alias("topic"), F.lit(None).cast("long").alias("recent"),
                       F.lit(None).cast("long").alias("prior"), "velocity")
    both = per_topic.unionByName(overall)
    return both.select("topic", "recent", "prior", F.round("velocity", 9).alias("velocity"),
                       trend_from_velocity(F.col("velocity")).alias("trend"))


def _global_trend(spark, sf_dir) -> str:
    """The one trend every cluster shares (one small row read on the driver)."""
    row = trend_velocity(spark, sf_dir).filter(F.col("topic") == "*").select("trend").first()
    return row["trend"] if row else "stable"


def _opportunity(spark, sf_dir):
    from needlens.functions.score import first_importance, first_satisfaction, opportunity
    recs = _event_records(spark, sf_dir)
    trend = _global_trend(spark, sf_dir)
    agg = recs.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.avg("intensity").alias("mean_intensity"),
        F.bool_or(F.col("value") >= 480).alias("has_mature_solution"),
        F.min("ord").alias("first_ord"))
    imp = first_importance(F.col("post_count"), F.col("mean_intensity"))
    sat = first_satisfaction(F.col("has_mature_solution"))
    return agg.withColumn("opportunity", opportunity(imp, sat, F.col("mean_intensity"),
                                                     F.col("has_mature_solution"),
                                                     F.lit(trend))).withColumn("trend", F.lit(trend))


@query
def opportunity(spark, sf_dir):
    """C9 + C10 (+ A6, A7) for need clusters = (user, event type)."""
    o = _opportunity(spark, sf_dir)
    return o.select("user_id", "event_type", "post_count",
                    F.round("mean_intensity", 9).alias("mean_intensity"),
                    "has_mature_solution",
                    F.round("opportunity.importance", 9).alias("importance"),
                    "opportunity.satisfaction", "opportunity.raw_score",
                    "opportunity.intensity_weight", "opportunity.solution_weight",
                    "opportunity.trend_boost", "opportunity.final_score",
                    "trend", "first_ord")


@query
def top_clusters(spark, sf_dir):
    """O1 + O2: the 10 best clusters by final score (ties: first seen)."""
    from needlens.operators.ranking import top_n
    o = _opportunity(spark, sf_dir).select("user_id", "event_type", "first_ord",
                                           F.col("opportunity.final_score").alias("final_score"))
    return top_n(o, [F.desc("final_score"), F.asc("first_ord")], 10, "rank")


@query
def source_sets(spark, sf_dir):
    """A8 + U3: per nation, first 5 sorted distinct priorities (root causes)
    and all sorted distinct order states (source topics)."""
    from needlens.operators.profile import distinct_sorted
    recs = _order_records(spark, sf_dir)
    rc = distinct_sorted(recs, "need_cluster_id", "root_cause", 5, "top_scenarios")
    st = distinct_sorted(recs, "need_cluster_id", "source_topic", None, "source_topics")
    return rc.join(st, "need_cluster_id", "full").select(
        "need_cluster_id",
        F.array_join("top_scenarios", ",").alias("top_scenarios"),
        F.array_join("source_topics", ",").alias("source_topics"))


@query
def creator_join(spark, sf_dir):
    """Every order with its creator profile (left join)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey, "left").select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query
def persona_matrix(spark, sf_dir):
    """Nation x market segment record counts (pivot)."""
    recs = _order_records(spark, sf_dir).withColumn("segment", F.upper("user_type"))
    # the pivot's column names: the domain of a categorical column (a handful of values)
    segments = [r[0] for r in recs.select("segment").distinct().orderBy("segment").collect()]
    return (recs.groupBy("need_cluster_id").pivot("segment", segments).count().na.fill(0))


@query
def topics_over_time(spark, sf_dir):
    """Records and distinct users per (topic, day)."""
    ev = load(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("topic"), F.to_date("ts").alias("day"))
              .agg(F.count(F.lit(1)).alias("n_posts"), F.countDistinct("user_id").alias("n_users")))


@query
def top_per_topic(spark, sf_dir):
    """Top 50 records per topic by value (ties: event_id)."""
    from pyspark.sql import Window
    ev = load(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), "event_id", "value")
    w = Window.partitionBy("topic").orderBy(F.desc("value"), F.asc("event_id"))
    return ev.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 50)


@query
def stage_metrics(spark, sf_dir):
    """Ingest counts per source."""
    from needlens.operators.metrics import ingest_metrics
    posts = posts_from_documents(load(spark, sf_dir, "documents"))
    return ingest_metrics(posts, "topic").withColumnRenamed("topic", "source")


# --- keyed results and run history (K, R) -----------------------------------

NOW = "2024-01-20 00:00:00"


def _puts(spark, sf_dir):
    from needlens.operators.results import cache_key, puts
    ev = load(spark, sf_dir, "events")
    key = cache_key(F.lit("events"), [F.col("event_type"), F.col("user_id")])
    # ts keeps its type (timestamp_ntz), so time filters reach the parquet scan
    return puts(ev, key, F.col("props"), F.col("ts"), F.floor(F.col("value") / 10), F.col("event_id"))


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@query
def fresh_results(spark, sf_dir):
    """K1 + K2 + W6: the fresh value of every key as of NOW."""
    from needlens.operators.results import get_fresh
    fresh = get_fresh(_puts(spark, sf_dir), _now())
    return fresh.select("cache_key", "value", "written_at", "expires")


@query
def missing_keys(spark, sf_dir):
    """K4 + J4: keys requested after NOW that have no fresh result."""
    from needlens.operators.results import cache_key, get_fresh, misses
    ev = load(spark, sf_dir, "events").filter(F.col("ts") > _now())
    req = ev.select(cache_key(F.lit("events"), [F.col("event_type"), F.col("user_id")]).alias("cache_key"),
                    "event_type", "user_id").distinct()
    fresh = get_fresh(_puts(spark, sf_dir), _now())
    return misses(req, fresh)


@query
def stored_or_fetched(spark, sf_dir):
    """J4 + K2 + K4: every key requested after NOW with its stored value, or the last one written since."""
    from needlens.operators import results as R
    table = _puts(spark, sf_dir)
    since = table.filter(F.col("written_at") > _now())
    requested = since.select("cache_key").distinct()
    return R.stored_or_fetched(requested, R.get_fresh(table, _now()), R.latest(since))


@query
def purged_results(spark, sf_dir):
    """K3: writes left after the expired ones and all writes of the keys of new sign-ups are gone."""
    from needlens.operators.results import cache_key, delete_keys, purge_expired
    ev = load(spark, sf_dir, "events").filter((F.col("ts") > _now()) & (F.col("event_type") == "signup"))
    gone = ev.select(cache_key(F.lit("events"), [F.col("event_type"), F.col("user_id")]).alias("cache_key"))
    left = delete_keys(purge_expired(_puts(spark, sf_dir), _now()), gone)
    return left.select("cache_key", "value", "written_at", "expires", "seq")


def _status_events(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "signup", F.lit("pending"))
               .when(F.col("event_type").isin("view", "click"), F.lit("running"))
               .when(F.col("event_type") == "purchase", F.lit("completed"))
               .otherwise(F.lit("failed")))
    return ev.select(F.col("user_id").cast("string").alias("run_id"), status.alias("status"),
                     "ts", F.col("event_id").alias("seq"))


@query
def run_latest(spark, sf_dir):
    """Current state of every run from its status events."""
    from needlens.operators.results import run_state
    return run_state(_status_events(spark, sf_dir))


@query
def run_list(spark, sf_dir):
    """R2 + O3: runs newest first, numbered without a single-task window."""
    from needlens.operators.ranking import global_row_number
    from needlens.operators.results import run_state
    runs = run_state(_status_events(spark, sf_dir)).select("run_id", "status", "created_at")
    return global_row_number(runs, ["created_at", "run_id"], [False, True], "list_rank")


# --- vectors, neighbours, density clustering (A10, C7, J5, C3) --------------

@query
def cluster_centroids(spark, sf_dir):
    """A10: mean embedding per label, one row per dimension."""
    from needlens.operators.vectors import centroids_long
    emb = load(spark, sf_dir, "embeddings")
    return centroids_long(emb, "label", "embedding").select(
        "label", "dim", F.round("mean", 9).alias("mean"), "n_points")


@query
def representatives(spark, sf_dir):
    """C7 + W2: the 5 embeddings closest (cosine) to their label's centroid."""
    from needlens.operators.vectors import representatives as reps
    emb = load(spark, sf_dir, "embeddings").withColumn("ord", F.col("vec_id"))
    r = reps(emb, "label", "embedding", "ord", 5)
    return r.select("label", "rep_rank", "vec_id", F.round("sim", 9).alias("sim"))


RADIUS_EPS = 1.15


@query
def radius_pairs(spark, sf_dir):
    """J5, partition tree: all embedding pairs within Euclidean 1.15."""
    from needlens.operators.metrictree import radius_pairs_tree
    emb = load(spark, sf_dir, "embeddings")
    pairs = radius_pairs_tree(emb, "vec_id", "embedding", RADIUS_EPS)
    return pairs.select("id_a", "id_b", F.round("dist", 9).alias("dist"))


@query
def radius_pairs_hashed(spark, sf_dir):
    """J5, p-stable hashing: embedding pairs within 1.15, each with probability 0.95 at least."""
    from needlens.operators.lsh import radius_pairs_lsh
    emb = load(spark, sf_dir, "embeddings")
    pairs = radius_pairs_lsh(emb, "vec_id", "embedding", RADIUS_EPS)
    return pairs.select("id_a", "id_b", F.round("dist", 9).alias("dist"))


@query
def nearest_neighbours(spark, sf_dir):
    """J5, partition tree: the five nearest other embeddings of each."""
    from needlens.operators.metrictree import nearest_rows
    from needlens.operators.scratch import Scratch
    rows = nearest_rows(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", 5, Scratch(spark, "neighbours"))
    return rows.select(F.col("id").alias("vec_id"), "rank", "other", F.round("dist", 9).alias("dist"))


DENSITY_EPS = 0.25


def _user_features(spark, sf_dir):
    """Per user: event count and mean value, z-scored (population stats are
    one small row read on the driver)."""
    ev = load(spark, sf_dir, "events")
    u = ev.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                  F.avg("value").alias("m"))
    st = u.agg(F.avg("n"), F.stddev_samp("n"), F.avg("m"), F.stddev_samp("m")).first()
    return u.select("user_id",
                    ((F.col("n") - F.lit(st[0])) / F.lit(st[1])).alias("x"),
                    ((F.col("m") - F.lit(st[2])) / F.lit(st[3])).alias("y"))


@query
def density_clusters(spark, sf_dir):
    """C3 (DBSCAN*, min_samples 3, min size 5, eps 0.25) on users' z-scored
    (event count, mean value)."""
    from needlens.operators.density import dbscan
    feats = _user_features(spark, sf_dir).withColumn("v", F.array("x", "y"))
    return dbscan(feats, "user_id", "v", DENSITY_EPS, 3, 5)


@query
def reachability_tree(spark, sf_dir):
    """Minimum spanning tree of the users under mutual reachability (third neighbour)."""
    from needlens.operators import hierarchy as H
    from needlens.operators import metrictree as M
    from needlens.operators.scratch import Scratch
    scratch = Scratch(spark, "tree")
    feats = _user_features(spark, sf_dir).withColumn("v", F.array("x", "y"))
    points, members = M.distinct_points(feats, "user_id", "v", scratch)
    tree = M.build(points, scratch)
    lists = M.nearest(tree, H.NEIGHBOURS)
    cores = scratch.keep(H.core_distances(tree, lists, 3), "cores")
    edges = H.spanning_tree(H.spanning_levels(tree, lists, cores, H.NEIGHBOURS))
    return edges.select("lo", "hi", F.round("w", 9).alias("w"))


@query
def varied_density_clusters(spark, sf_dir):
    """C3 (HDBSCAN*, min_samples 3, min size 5) on the users, no radius given."""
    from needlens.operators.hierarchy import hdbscan
    feats = _user_features(spark, sf_dir).withColumn("v", F.array("x", "y"))
    return hdbscan(feats, "user_id", "v", 3, 5)


@query
def grid_pairs(spark, sf_dir):
    """J5, grid: pairs of users within 0.25 in the z-scored feature plane."""
    from needlens.operators.neighbors import radius_pairs_grid
    pairs = radius_pairs_grid(_user_features(spark, sf_dir), "user_id", ["x", "y"], DENSITY_EPS)
    return pairs.select("id_a", "id_b", F.round("dist", 9).alias("dist"))


# --- model answers (P11-P16, F3) ------------------------------------------------

def _raw_answers(spark, sf_dir):
    """Raw extraction answers as a model returns them, derived from events:
    plain, fenced, wrapped in prose, with ``\\'``, with a raw newline in a
    string, not JSON at all, or an array; fields vary in type and presence.
    The post text is ``event <id> of user <u> <type>``.  Built in stages so
    no sub-expression is inlined more than once."""
    ev = load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    e, u, t, k = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("k")
    s = lambda c: c.cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def kv(name, val):  # concat is null when the value is null: the key is left out
        return F.concat(F.lit(f'"{name}": '), val)

    types = F.array(*[F.lit(x) for x in ("trader", "developer", "investor", "researcher", "casual", "alien")])
    levels = F.array(*[F.lit(x) for x in ("beginner", "intermediate", "expert")])
    pairs = [
        kv("is_financial", F.when(t == "error", F.lit("false")).when(t == "view", F.lit(None))
                            .otherwise(F.lit("true"))),
        kv("entity", F.when(k % 4 == 0, F.lit('""')).when(k == 7, F.lit("5")).otherwise(q(t))),
        kv("feature", q(F.concat(F.lit("f"), s(k)))),
        kv("opinion", F.when(e % 7 == 3, F.lit("\"it\\'s bad\""))
                       .when(e % 7 == 4, F.lit('"line1\nline2"'))
                       .otherwise(q(F.concat(F.lit("opinion "), s(u))))),
        kv("need_type", F.when(k % 13 == 0, F.lit('["explicit"]'))
                         .when(k % 2 == 1, F.lit('"explicit"')).otherwise(F.lit('"implicit"'))),
        kv("pain_point", F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit("null"))
                          .otherwise(q(F.concat(F.lit("pain "), s(k))))),
        kv("root_cause", F.when(u % 5 == 0, F.lit("12")).otherwise(q(F.concat(F.lit("cause"), s(u % 4))))),
        kv("sentiment", F.when(u % 3 == 0, F.lit('"positive"')).when(u % 3 == 1, F.lit('"mixed"'))
                         .otherwise(F.lit('"negative"'))),
        kv("emotion", F.when(k % 5 == 0, F.lit('""')).otherwise(q(t))),
        kv("intensity", F.when(e % 11 == 0, F.lit("null")).when(e % 13 == 0, F.lit(None))
                         .when(e % 5 == 0, q(F.concat(s(k), F.lit("e-2"))))
                         .otherwise(F.concat(s(k * 2), F.lit("e-2")))),
        kv("evidence", F.when(k % 6 == 0, F.lit(None)).otherwise(q(F.concat(F.lit("ev "), s(e))))),
        kv("user_type", q(F.element_at(types, (u % 6 + 1).cast("int")))),
        kv("experience_level", q(F.element_at(levels, (e % 3 + 1).cast("int")))),
    ]
    body = ev.select("event_id", F.concat(F.lit("event "), s(e), F.lit(" of user "), s(u), F.lit(" "), t)
                     .alias("text"),
                     F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("body"))
    b, e = F.col("body"), F.col("event_id")
    answer = (F.when(e % 7 == 1, F.concat(F.lit("```json\n"), b, F.lit("\n```")))
               .when(e % 7 == 2, F.concat(F.lit("Here is the analysis: "), b, F.lit(" Hope this helps.")))
               .when(e % 7 == 5, F.lit("Sorry, I cannot help with that."))
               .when(e % 7 == 6, F.concat(F.lit("["), b, F.lit("]")))
               .otherwise(b))
    return body.select("event_id", "text", answer.alias("answer"))


@query
def extract_records(spark, sf_dir):
    """P11-P16 + F3: validated need records from raw answers."""
    from needlens.functions.respond import need_records, parse_answers
    from needlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # model output is written before it is parsed (a stage table, S8)
    raw = _raw_answers(spark, sf_dir).checkpoint(eager=True)
    a = parse_answers(raw, "answer", "v")
    # written before the filter on the flag (see needs.extract_needs)
    r = need_records(a, "v", "text", "r").select("event_id", "r").checkpoint(eager=True)
    return r.where("r.keep").select(
        "event_id", "r.entity", "r.feature", "r.opinion", "r.need_type", "r.pain_point", "r.root_cause",
        "r.sentiment", "r.emotion", "r.intensity", "r.evidence", "r.user_type", "r.experience_level")


# --- composed stages (C4, C5, C12, C14, C15) --------------------------------------

def _doc_posts(spark, sf_dir):
    return collect(posts_from_documents(load(spark, sf_dir, "documents")), key="text")


@query
def topic_pipeline(spark, sf_dir):
    """C4: topic clustering of the cleaned documents (hashing embedding)."""
    from needlens.plans.topics import cluster_topics
    t = cluster_topics(_doc_posts(spark, sf_dir))
    return t.select("post_id", "cluster_id", "topic_label",
                    F.array_join("topic_keywords", ",").alias("topic_keywords"))


def _doc_clusters(spark, sf_dir):
    from needlens.plans.needs import aggregate_needs, extract_needs, kept_records
    from needlens.plans.topics import cluster_topics
    topics = cluster_topics(_doc_posts(spark, sf_dir)).checkpoint(eager=True)
    recs = kept_records(extract_needs(topics)).checkpoint(eager=True)
    return aggregate_needs(recs, "stable")


@query
def need_clusters(spark, sf_dir):
    """L2 + L3 (C5, C8 default, C12): ranked need clusters of the documents."""
    c = _doc_clusters(spark, sf_dir)
    return c.select("rank", "need_cluster_id", "cluster_name", "post_count",
                    F.col("opportunity.final_score").alias("final_score"),
                    F.array_join("keywords", ",").alias("keywords"))


@query
def pipeline_specs(spark, sf_dir):
    """The full run on the documents; one row per spec."""
    from needlens.plans.run import run
    res = run(posts_from_documents(load(spark, sf_dir, "documents")), dedup_key="text")
    if res.specs is None:
        return spark.createDataFrame([], "rank long, skill_name string, need_name string, final_score double, post_count long")
    return res.specs.select("rank", "skill_name", "need_name",
                            F.col("opportunity.final_score").alias("final_score"), "post_count")


def _checked():
    from needlens.plans import checked
    return {f.__name__: f for f in (checked.topic_stage, checked.need_stage, checked.full_run, checked.run_metrics)}


QUERIES.update(_checked())  # the same stages with given labels, which SQL can check


# --- specs and report on event clusters (C13, P20, P21, J6, S7, W7) ---------------

def _top_event_clusters(spark, sf_dir):
    """The 10 best (user, event type) clusters with the L3 fields refinement needs."""
    from needlens.operators.ranking import top_n
    recs = _event_records(spark, sf_dir)
    o = _opportunity(spark, sf_dir)
    span = recs.groupBy("user_id", "event_type").agg(F.min("ts").alias("first_ts"),
                                                     F.max("ts").alias("last_ts"))
    o = o.join(span, ["user_id", "event_type"]).withColumn(
        "_final", F.col("opportunity.final_score"))
    return top_n(o, [F.desc("_final"), F.asc("first_ord")], 10, "rank").drop("_final")


def _spec_answers(spark, sf_dir, top):
    """Spec answers for the top clusters, from the labels of doc_id = user_id
    (missing label: an answer without numbers, so the L3 values stay):
    importance 5 + 4 x quality (number), satisfaction 2 + 3 x toxic (text),
    mature flag = quality as text true/false."""
    lab = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("user_id"), "quality", "toxic")
    j = top.join(lab, "user_id", "left")
    ans = F.when(F.col("quality").isNull(), F.lit('{"skill_name": ""}')).otherwise(F.to_json(F.struct(
        F.concat(F.lit("skill-"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("skill_name"),
        (F.lit(5) + F.lit(4) * F.col("quality")).alias("importance"),
        (F.lit(2) + F.lit(3) * F.col("toxic")).cast("string").alias("satisfaction"),
        F.when(F.col("quality") == 1, F.lit("true")).otherwise(F.lit("false")).alias("has_mature_solution"))))
    return j.withColumn("answer", ans)


def _event_specs(spark, sf_dir):
    from needlens.plans.specs import refine
    top = _top_event_clusters(spark, sf_dir)
    # L3 shape: name defaults, rounded mean intensity in the emotion profile
    top = (top.withColumn("need_cluster_id", F.col("first_ord"))
              .withColumn("cluster_name", F.concat(F.lit("Cluster "), F.col("first_ord").cast("string")))
              .withColumn("description", F.lit(""))
              .withColumn("emotion_profile", F.struct(
                  F.col("event_type").alias("dominant_emotion"),
                  F.bround("mean_intensity", 3).alias("avg_intensity"),
                  F.col("trend").alias("trend")))
              .withColumn("evidence_samples", F.array().cast("array<string>"))
              .withColumn("personas", F.array().cast(
                  "array<struct<segment_name:string,post_count:bigint,pct:int,experience_level:string>>"))
              .withColumn("existing_solutions", F.array().cast(
                  "array<struct<name:string,coverage:string,limitation:string>>"))
              .withColumn("source_topics", F.array(F.col("event_type")))
              .withColumn("source_topic_labels", F.array().cast("array<string>")))
    specs = refine(_spec_answers(spark, sf_dir, top))
    return specs.where("_ok").drop("_ok")


@query
def refined_specs(spark, sf_dir):
    """C13 + P20 + P21 + J6: top clusters re-scored with their spec answer."""
    s = _event_specs(spark, sf_dir)
    return s.select("rank", "source_cluster_id", "skill_name", "need_name", "need_type",
                    F.col("opportunity.importance").alias("importance"),
                    F.col("opportunity.satisfaction").alias("satisfaction"),
                    F.col("opportunity.raw_score").alias("raw_score"),
                    F.col("opportunity.intensity_weight").alias("intensity_weight"),
                    F.col("opportunity.solution_weight").alias("solution_weight"),
                    F.col("opportunity.trend_boost").alias("trend_boost"),
                    F.col("opportunity.final_score").alias("final_score"),
                    "data_period", "post_count")


@query
def report_rows(spark, sf_dir):
    """S7 + W7 + A12: the markdown report of the refined specs as lines."""
    from needlens.sources.sinks import report_lines
    from needlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    specs = _event_specs(spark, sf_dir).checkpoint(eager=True)  # read three times below
    n_posts = load(spark, sf_dir, "events").count()
    n_clusters = load(spark, sf_dir, "events").select("user_id", "event_type").distinct().count()
    return report_lines(specs, n_posts, n_clusters, "events")


# --- feed readers (S1, P1-P7, F1, F2, W1) -------------------------------------------

@query
def feed_ingest(spark, sf_dir):
    """S1 + L0: task-feed documents derived from ``documents`` are written as
    JSON lines, read back as VARIANT, flattened with the per-key rules,
    filtered (F1, F2) and deduplicated first-wins on post_id."""
    import os
    import uuid
    from needlens.session import stage_dir
    from needlens.sources.feeds import documents_as_task_feed, good_posts, read_task_feed
    path = os.path.join(stage_dir(spark, "feeds"), uuid.uuid4().hex)
    documents_as_task_feed(load(spark, sf_dir, "documents")).write.mode("overwrite").text(path)
    posts, _states = read_task_feed(spark, path)
    kept = collect(good_posts(posts))
    return kept.select("post_id", "text", "network", "creator_id", "creator_followers", "interactions",
                       "sentiment_lc", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "topic")


def _written_feed(spark, lines) -> str:
    import os
    import uuid
    from needlens.session import stage_dir
    path = os.path.join(stage_dir(spark, "feeds"), uuid.uuid4().hex)
    lines.write.text(path)
    return path


@query
def single_topic_feed(spark, sf_dir):
    """The readable posts of a single-topic feed, with the topic's last state."""
    from needlens.sources.feeds import documents_as_topic_feed, good_posts, read_topic_feed
    path = _written_feed(spark, documents_as_topic_feed(load(spark, sf_dir, "documents"), F.lit("Every Source"), True))
    posts, states = read_topic_feed(spark, path, "every-source")
    # one state, that of the topic; the posts, whose stage table is far smaller in Spark's estimate than
    # in fact (a few of its many fields are read), must not be the side that is broadcast
    rows = good_posts(posts).join(F.broadcast(states.select("topic", "velocity")), "topic")
    return rows.select("post_id", "topic", "text", "network", "interactions", "sentiment_lc",
                       F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "velocity")


@query
def feed_states(spark, sf_dir):
    """Posts, malformed posts and last state of every topic of a feed."""
    from needlens.sources.feeds import documents_as_topic_feed, read_task_feed
    path = _written_feed(spark, documents_as_topic_feed(load(spark, sf_dir, "documents"), F.col("source"), False))
    posts, states = read_task_feed(spark, path)
    counts = posts.groupBy("topic").agg(F.count(F.lit(1)).alias("n_posts"), F.count_if(~F.col("_ok")).alias("n_malformed"))
    return counts.join(states.select("topic", "velocity"), "topic")


@query
def flat_feed(spark, sf_dir):
    """The readable posts of a flat feed by their fallback chains."""
    from needlens.sources.feeds import documents_as_flat_feed, good_posts, read_flat_feed
    path = _written_feed(spark, documents_as_flat_feed(load(spark, sf_dir, "documents")))
    return good_posts(read_flat_feed(spark, path, "flat")).select(
        "post_id", "topic", "text", "network", "creator_id", "interactions", "sentiment_lc",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


# --- documented extensions (D3, D4) --------------------------------------------------

@query
def user_segments(spark, sf_dir):
    """D3: users segmented by their event-type shares (KMeans, 5 segments)."""
    from needlens.operators.segments import kmeans_segments, user_shares
    ev = load(spark, sf_dir, "events")
    # share columns: the domain of a categorical column (a handful of values)
    types = [r[0] for r in ev.select("event_type").distinct().orderBy("event_type").collect()]
    shares = user_shares(ev, "user_id", "event_type", types)
    return kmeans_segments(shares, "shares").select("user_id", "segment")


@query
def merged_topics(spark, sf_dir):
    """Embedding labels merged down to 5 topics by their centroids."""
    from needlens.operators.segments import merge_topics
    from needlens.operators.vectors import centroids
    emb = load(spark, sf_dir, "embeddings")
    return merge_topics(centroids(emb, "label", "embedding"), "label", 5)


# --- prompt rendering (P9, P10) -------------------------------------------------------

@query
def render_prompts(spark, sf_dir):
    """P9 + P10: the solutions prompt for every part, with the part type's
    first three words as a Python list text, the name as description and the
    name's words as keywords."""
    from needlens.functions.respond import join_list, python_list_text, render
    from needlens.plans.prompts import SOLUTIONS
    part = load(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    prompt = render(SOLUTIONS, [("cluster_name", python_list_text(F.split("p_type", " "), 3)),
                                ("description", F.col("p_name")),
                                ("keywords", join_list(words))])
    return part.select("p_partkey", prompt.alias("prompt"), F.char_length(prompt).alias("prompt_chars"))
