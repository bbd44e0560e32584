"""Topic feed readers.

Feeds are schemaless JSON with per-key fallbacks, so documents are parsed to
VARIANT and every field rule checks presence, JSON null and JSON type the
way the reference's ``item.get(k) or default`` code does.  A row whose
fields cannot be built is dropped alone (P7); the count of dropped rows is
kept in ``_bad``.

Input: either JSON-lines files (one feed document per line: many documents,
read in parallel) or whole JSON files (``whole_files=True``, one document per
file).  Arrival order ``ord`` numbers the posts by (document order, topic
position, post position); the document order is the ``seq`` key of the document
when present, else the file path order and line position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from needlens.functions import post as P
from needlens.functions.respond import Field
from needlens.functions.text import normalize_topic, strip


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """``doc_ord, doc`` (VARIANT) for every feed document under ``path``.

    ``doc_ord`` numbers the documents 0..n-1 in the order (``data.seq`` when
    present, file path, split start, line position inside the split); the
    position comes from ``monotonically_increasing_id``, which increases in
    reading order inside a split.  The numbering is distributed
    (``global_row_number``), not a single-task window.
    """
    from needlens.operators.ranking import global_row_number

    raw = spark.read.text(path, wholetext=whole_files)
    raw = raw.select(F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_blk"),
                     F.monotonically_increasing_id().alias("_pos"), F.col("value"))
    docs = raw.where(F.length(F.trim("value")) > 0).withColumn("doc", F.try_parse_json("value"))
    docs = docs.withColumn("_seq", F.try_variant_get("doc", "$.data.seq", "bigint"))
    numbered = global_row_number(docs.select("_seq", "_file", "_blk", "_pos", "doc"),
                                 ["_seq", "_file", "_blk", "_pos"], [True, True, True, True], "_n")
    return numbered.select((F.col("_n") - 1).alias("doc_ord"), "doc")


def _vf(v: Column, path: str) -> Field:
    fv = F.try_variant_get(v, path, "variant")
    return Field(fv, F.schema_of_variant(fv))


def _truthy_text(f: Field) -> tuple[Column, Column]:
    """``x or ""`` where x must be text when truthy: (value, ok)."""
    from needlens.functions.respond import as_string, is_falsy, is_string
    falsy = is_falsy(f)
    return F.when(falsy, F.lit("")).otherwise(as_string(f)), falsy | is_string(f)


def _id_text(f: Field) -> Column:
    """``str(x)``; missing and null -> "" (decision)."""
    from needlens.functions.respond import is_json_null, is_missing, is_string
    return (F.when(is_missing(f) | is_json_null(f), F.lit(""))
             .when(is_string(f), F.try_variant_get(f.v, "$", "string"))
             .otherwise(F.to_json(f.v)))


def _int_or_null(f: Field) -> tuple[Column, Column]:
    from needlens.functions.respond import is_bool, is_json_null, is_missing, is_number, is_string
    val = (F.when(is_number(f) | is_bool(f), F.try_variant_get(f.v, "$", "bigint"))
            .when(is_string(f), F.trim(F.try_variant_get(f.v, "$", "string")).try_cast("bigint")))
    return val, is_missing(f) | is_json_null(f) | val.isNotNull()


def _number(f: Field) -> Column:
    from needlens.functions.respond import is_bool, is_number, is_string
    return (F.when(is_bool(f) | is_number(f), F.try_variant_get(f.v, "$", "double"))
             .when(is_string(f), F.trim(F.try_variant_get(f.v, "$", "string")).try_cast("double")))


TASK_POST_FIELDS = ("id", "post_title", "post_description", "post_type", "creator_id", "creator_followers",
                    "interactions_24h", "interactions_total", "post_sentiment", "post_created")


ARRIVAL = ("doc_ord", "t_pos", "p_pos")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ord``, 0.. in the order of arrival, written once: the rules that
    follow read plain columns and are compiled on their own."""
    from needlens.operators.ranking import global_row_number
    keys = list(ARRIVAL)
    return global_row_number(rows, keys, [True] * 3, "_n").withColumn("ord", F.col("_n") - 1).drop("_n", *keys)


def parse_task_posts(items: DataFrame, numbered: bool = True) -> DataFrame:
    """P1-P7 for task-feed posts; ``items`` has ``item`` (VARIANT), ``topic`` and the
    arrival columns.

    Each field (VARIANT) and its JSON type are materialised once, then the
    rules read those columns.  On a stream nothing can be numbered: ``ord`` is then
    the arrival columns as a struct, which sorts the same way.
    """
    from needlens.functions.respond import as_string, extract_fields, fld, is_falsy, is_missing, is_string
    d = extract_fields(items, "item", TASK_POST_FIELDS, "_p").drop("item")
    d = _numbered(d) if numbered else d.withColumn("ord", F.struct(*ARRIVAL))
    f = lambda n: fld(n, "_p")
    title, ok_t = _truthy_text(f("post_title"))
    desc, ok_d = _truthy_text(f("post_description"))
    text = strip(F.concat(title, F.when(desc != "", F.concat(F.lit(" "), desc)).otherwise(F.lit(""))))
    pt = f("post_type")
    post_type = F.when(is_missing(pt), F.lit("unknown")).otherwise(as_string(pt))
    ok_pt = is_missing(pt) | is_string(pt)  # an explicit null or non-text raises
    created = f("post_created")
    epoch = _number(created)
    ts = F.when(is_falsy(created), P.default_ts()).otherwise(F.timestamp_seconds(epoch.cast("long")))
    ok_ts = is_falsy(created) | (epoch.isNotNull() & ~is_string(created))
    sent = f("post_sentiment")
    s_val = _number(sent)
    sentiment = F.when(is_falsy(sent), F.lit(P.DEFAULT_SENTIMENT_RAW)).otherwise(s_val) * F.lit(P.SENTIMENT_SCALE)
    ok_s = is_falsy(sent) | s_val.isNotNull()
    followers, ok_f = _int_or_null(f("creator_followers"))
    i24, ok_i1 = _int_or_null(f("interactions_24h"))
    itot, ok_i2 = _int_or_null(f("interactions_total"))
    inter = P.interactions(i24, itot)
    ok = ok_t & ok_d & ok_pt & ok_ts & ok_s & ok_f & ok_i1 & ok_i2
    return d.select(
        _id_text(f("id")).alias("post_id"), text.alias("text"),
        _id_text(f("creator_id")).alias("creator_id"), P.network(post_type).alias("network"),
        followers.alias("creator_followers"), inter.alias("interactions"),
        sentiment.alias("sentiment_lc"), ts.alias("timestamp"), F.col("topic"), F.col("ord"),
        F.coalesce(ok, F.lit(False)).alias("_ok"))


def _posts_of(entries: DataFrame) -> DataFrame:
    """entries(doc_ord, t_pos, topic, entry) -> one row per post with ord."""
    items = entries.select(
        "topic", "doc_ord", "t_pos",
        F.posexplode(F.coalesce(F.try_variant_get("entry", "$.posts", "array<variant>"),
                                F.array().cast("array<variant>"))).alias("p_pos", "item"))
    return parse_task_posts(items)


def _states_of(entries: DataFrame) -> DataFrame:
    """``states[topic] = state or {}``: the last entry of a repeated topic wins."""
    st = entries.select("topic", F.col("doc_ord"), F.col("t_pos"),
                        F.try_variant_get("entry", "$.state", "variant").alias("state"))
    last = st.groupBy("topic").agg(F.max_by("state", F.struct("doc_ord", "t_pos")).alias("state"))
    return last.select("topic", "state",
                       F.try_variant_get("state", "$.velocity", "double").alias("velocity"),
                       F.try_variant_get("state", "$.sentiment", "double").alias("sentiment"))


def read_task_feed(spark: SparkSession, path: str, whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """Multi-topic feed ``{data: {task_id, topics: [{topic, state, posts}]}}``.

    Returns ``(posts, states)``; posts carry ``_ok`` (False = malformed, P7).
    """
    docs = read_documents(spark, path, whole_files)
    entries = docs.select("doc_ord", F.posexplode(F.coalesce(
        F.try_variant_get("doc", "$.data.topics", "array<variant>"),
        F.array().cast("array<variant>"))).alias("t_pos", "entry"))
    entries = entries.withColumn("topic", F.try_variant_get("entry", "$.topic", "string"))
    return _posts_of(entries), _states_of(entries)


def read_topic_feed(spark: SparkSession, path: str, topic: str,
                    whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """S2 + S3: a topic's feed in either shape.

    Multi-topic documents: the first entry whose normalised name (P8) equals
    the normalised request (none: error).  Single-topic documents
    ``{data: {task_id, topic, state, posts}}``: all posts.  Posts get the
    requested topic name.
    """
    docs = read_documents(spark, path, whole_files)
    multi = F.try_variant_get("doc", "$.data.topics", "array<variant>")
    want = normalize_topic(F.lit(topic))
    m = docs.where(multi.isNotNull()).select("doc_ord", F.posexplode(multi).alias("t_pos", "entry"))
    m = m.where(normalize_topic(F.coalesce(F.try_variant_get("entry", "$.topic", "string"), F.lit(""))) == want)
    first = m.groupBy().agg(F.min_by(F.struct("doc_ord", "t_pos"), F.struct("doc_ord", "t_pos")).alias("k"))
    m = m.join(first.select(F.col("k.doc_ord").alias("doc_ord"), F.col("k.t_pos").alias("t_pos")),
               ["doc_ord", "t_pos"])
    single = docs.where(multi.isNull()).select(
        "doc_ord", F.lit(0).alias("t_pos"), F.try_variant_get("doc", "$.data", "variant").alias("entry"))
    entries = m.unionByName(single).withColumn("topic", F.lit(topic))
    if entries.limit(1).count() == 0:
        raise ValueError(f"Topic {topic!r} not found in {path}")
    return _posts_of(entries), _states_of(entries)


def read_flat_feed(spark: SparkSession, path: str, topic: str, whole_files: bool = False) -> DataFrame:
    """Alternate flat feed ``{data: [post, ...]}`` with fallback chains
    (P1b-P5b); the posts get ``topic``."""
    from needlens.functions.respond import as_string, is_falsy, is_missing, is_number, is_string
    docs = read_documents(spark, path, whole_files)
    items = docs.select("doc_ord", F.posexplode(F.coalesce(
        F.try_variant_get("doc", "$.data", "array<variant>"), F.array().cast("array<variant>"))).alias("p_pos", "item"))
    it = F.col("item")

    def first_truthy(*paths):
        fields = [_vf(it, p) for p in paths]
        val = F.lit(None)
        for f in reversed(fields):
            val = F.when(~is_falsy(f), F.when(is_string(f), as_string(f)).otherwise(F.to_json(f.v))).otherwise(val)
        return val

    # a chosen value that can't be read stays null and makes the post malformed
    text = F.lit("")
    for f in (_vf(it, p) for p in ("$.title", "$.post_title", "$.text", "$.body")):
        text = F.when(is_falsy(f), text).when(is_string(f), as_string(f))
    net_f, pt_f = _vf(it, "$.network"), _vf(it, "$.post_type")
    from_type = (F.when(is_missing(pt_f), F.lit("unknown"))
                  .when(is_string(pt_f), F.split_part(as_string(pt_f), F.lit("-"), F.lit(1))))
    network = F.when(is_falsy(net_f), from_type).when(is_string(net_f), as_string(net_f))
    ts_fields = [_vf(it, p) for p in ("$.created_at", "$.post_created", "$.time")]
    ts = P.default_ts()
    for f in reversed(ts_fields):
        val = F.when(is_number(f), F.timestamp_seconds(F.try_variant_get(f.v, "$", "double").cast("long"))) \
               .otherwise(F.try_to_timestamp(as_string(f)))
        ts = F.when(~is_falsy(f), val).otherwise(ts)
    sent = F.lit(P.DEFAULT_SENTIMENT_B)
    for f in (_vf(it, "$.sentiment"), _vf(it, "$.post_sentiment")):
        sent = F.when(is_falsy(f), sent).otherwise(_number(f))
    f24, ftot = _vf(it, "$.interactions_24h"), _vf(it, "$.interactions")
    i24, ok_24 = _int_or_null(f24)
    itot, ok_tot = _int_or_null(ftot)
    ok_inter = F.when(is_falsy(f24), is_falsy(ftot) | ok_tot).otherwise(ok_24)
    creator = F.coalesce(first_truthy("$.creator_id", "$.user_id"), F.lit(""))
    followers, ok_followers = _int_or_null(_vf(it, "$.creator_followers"))
    out = items.select(
        _id_text(_vf(it, "$.id")).alias("post_id"), text.alias("text"), creator.alias("creator_id"),
        network.alias("network"), followers.alias("creator_followers"), P.interactions(i24, itot).alias("interactions"),
        sent.alias("sentiment_lc"), ts.alias("timestamp"), F.lit(topic).alias("topic"),
        "doc_ord", F.lit(0).alias("t_pos"), "p_pos", (ok_inter & ok_followers).alias("_counts"))
    out = _numbered(out)
    read = F.col("_counts")
    for c in ("text", "network", "sentiment_lc", "timestamp"):
        read = read & F.col(c).isNotNull()
    return out.withColumn("_ok", F.coalesce(read, F.lit(False))).drop("_counts")


def good_posts(posts: DataFrame) -> DataFrame:
    """Rows that could be built (P7), without the flag."""
    return posts.where("_ok").drop("_ok")


# --- feed documents derived from a text table (for tests and the feed query) ------

def documents_as_task_feed(documents: DataFrame, chunk: int = 50) -> DataFrame:
    """Task-feed JSON lines built from ``documents``: one document per
    (source, block of ``chunk`` doc ids); every 25th document is repeated in
    a later ``repeat`` topic (first arrival wins in dedup).  Returns ``value``
    (JSON text) lines, each holding at most ``chunk`` posts."""
    d = documents
    post = F.struct(
        F.col("doc_id").alias("id"), F.col("lang").alias("post_title"), F.col("text").alias("post_description"),
        F.when(F.col("doc_id") % 10 != 0, F.concat(F.col("source"), F.lit("-post"))).alias("post_type"),
        F.col("lang").alias("creator_id"), F.col("n_chars").alias("creator_followers"),
        (F.col("n_chars") % 7).alias("interactions_24h"), (F.col("n_chars") % 5).alias("interactions_total"),
        (F.col("n_chars") % 6).alias("post_sentiment"),
        F.when(F.col("doc_id") % 9 == 0, F.lit(0)).otherwise(F.lit(1705312800) + F.col("doc_id") * 60)
         .alias("post_created"))
    block = F.floor(F.col("doc_id") / chunk)
    main = d.groupBy("source", block.alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", post.alias("p")))).alias("ps"))  # <= chunk rows
    main = main.select(F.col("blk").alias("seq"), F.col("source").alias("topic"), "ps")
    rep = d.where(F.col("doc_id") % 25 == 0).groupBy(F.floor(F.col("doc_id") / (chunk * 25)).alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", post.alias("p")))).alias("ps"))
    rep = rep.select((F.lit(1 << 28) + F.col("blk")).alias("seq"), F.lit("repeat").alias("topic"), "ps")
    both = main.unionByName(rep)
    doc = F.struct(F.struct(
        F.lit("derived").alias("task_id"), F.col("seq"),
        F.array(F.struct(F.col("topic"),
                         F.struct(F.lit(0.1).alias("velocity")).alias("state"),
                         F.transform("ps", lambda x: x["p"]).alias("posts"))).alias("topics")).alias("data"))
    return both.select(F.to_json(doc).alias("value"))


def _post_struct():
    """A post of a text table; by its id some have a type that is null, a time or a
    sentiment that is no number."""
    i = F.col("doc_id")
    created = F.when(i % 17 == 5, F.lit("yesterday").cast("variant")).otherwise((F.lit(1705312800) + i * 60).cast("variant"))
    feeling = F.when(i % 19 == 0, F.lit("high").cast("variant")).otherwise((F.col("n_chars") % 6).cast("variant"))
    return F.struct(
        i.alias("id"), F.col("lang").alias("post_title"), F.col("text").alias("post_description"),
        F.when(i % 14 != 3, F.concat(F.col("source"), F.lit("-post"))).alias("post_type"), F.col("lang").alias("creator_id"),
        (F.col("n_chars") % 7).alias("interactions_24h"), (F.col("n_chars") % 5).alias("interactions_total"),
        feeling.alias("post_sentiment"), created.alias("post_created"))


def documents_as_topic_feed(documents: DataFrame, topic: Column, single: bool, chunk: int = 50) -> DataFrame:
    """Feed JSON lines (``value``) of ``chunk`` posts each with malformed posts among
    them: single-topic documents or multi-topic ones of one entry.  The state's velocity
    is the block's number over 100."""
    blk = F.floor(F.col("doc_id") / chunk)
    rows = documents.groupBy(topic.alias("topic"), blk.alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", F.to_json(_post_struct(), {"ignoreNullFields": "false"}).alias("p")))).alias("ps"))
    posts = F.concat(F.lit("["), F.array_join(F.transform("ps", lambda x: x["p"]), ","), F.lit("]"))
    head = F.concat(F.lit('"topic": '), F.to_json(F.struct("topic")).substr(F.lit(10), F.length(F.to_json(F.struct("topic"))) - 10),
                    F.lit(', "state": {"velocity": '), (F.col("blk") / 100).cast("string"), F.lit('}, "posts": '), posts)
    body = head if single else F.concat(F.lit('"topics": [{'), head, F.lit("}]"))
    return rows.select(F.concat(F.lit('{"data": {"task_id": "t", "seq": '), F.col("blk").cast("string"), F.lit(", "), body, F.lit("}}")).alias("value"))


def documents_as_flat_feed(documents: DataFrame, chunk: int = 50) -> DataFrame:
    """Flat feed JSON lines (``value``): each field of a post under one of the names of
    its fallback chain, by the post's id; some posts hold values that can't be read."""
    i, n = F.col("doc_id"), F.col("n_chars")
    epoch = F.lit(1705312800) + i * 60
    post = F.struct(
        i.alias("id"), F.when(i % 4 == 0, F.col("text")).when(i % 4 == 1, F.lit("")).alias("body"),
        F.when(i % 4 == 1, F.col("text")).alias("text"), F.when(i % 4 == 2, F.col("text")).alias("post_title"),
        F.when(i % 4 == 3, F.col("text")).alias("title"), F.when(i % 3 == 0, F.col("source")).alias("network"),
        F.when(i % 3 == 1, F.concat("source", F.lit("-post"))).alias("post_type"),
        F.when(i % 5 == 0, F.lit("2024-02-01T10:00:00")).alias("created_at"), F.when(i % 5 == 1, epoch).alias("post_created"),
        F.when(i % 5 == 2, epoch).alias("time"),
        F.when(i % 29 == 3, F.lit("high").cast("variant")).when(i % 6 == 0, (n % 5).cast("variant")).alias("post_sentiment"),
        F.when(i % 6 < 2, 30 + i % 7).alias("sentiment"), F.when(i % 2 == 0, F.col("lang")).alias("creator_id"),
        F.when(i % 2 == 1, F.col("lang")).alias("user_id"),
        F.when(i % 23 == 7, F.lit("many").cast("variant")).otherwise((n % 7).cast("variant")).alias("interactions_24h"),
        (n % 5).alias("interactions"))
    rows = documents.groupBy(F.floor(i / chunk).alias("blk")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", F.to_json(post).alias("p")))).alias("ps"))
    return rows.select(F.concat(F.lit('{"data": ['), F.array_join(F.transform("ps", lambda x: x["p"]), ","), F.lit("]}")).alias("value"))


def read_topic_file(spark: SparkSession, folder: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """S3: exactly the file ``topic_{topic}.json`` of ``folder``, in either shape."""
    return read_topic_feed(spark, f"{folder.rstrip('/')}/topic_{topic}.json", topic, whole_files=True)
