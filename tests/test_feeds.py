"""S1-S4 on the FIXTURES feed, malformed rows and the derived feed."""

import json
import os
import tempfile

import pytest

from needlens.plans.collect import collect
from needlens.sources.feeds import good_posts, read_flat_feed, read_task_feed, read_topic_feed

FEED = {"data": {"task_id": "t1", "topics": [
    {"topic": "defi", "state": {"velocity": 0.1, "sentiment": 3.0}, "posts": [
        {"id": "n-11", "post_title": "Card statements", "post_description": "my bank exports the card statement as a picture only",
         "post_type": "tweet", "creator_id": "ann", "creator_followers": 12, "interactions_24h": 64,
         "post_sentiment": 2.5, "post_created": 1709287200},
        {"id": "n-12", "post_title": "Shared rent",
         "post_description": "three people and no simple list of who paid which month", "post_type": "youtube-post",
         "creator_id": "ben", "interactions_24h": 0, "interactions_total": 21, "post_sentiment": 1.0,
         "post_created": 1709287200},
        {"id": "bad", "post_title": "broken timestamp here for sure", "post_type": "tweet",
         "post_created": "yesterday"},
        {"id": "short", "post_title": "too short", "post_type": "tweet"}]},
    {"topic": "rate_cuts", "state": None, "posts": [
        {"id": "n-11", "post_title": "Card statements", "post_description": "the same id under another topic",
         "post_type": "tweet"},
        {"id": 7, "post_title": "Rate cuts are coming and markets love it", "post_sentiment": 0,
         "post_created": 0}]}]}}


@pytest.fixture()
def feed_dir():
    d = tempfile.mkdtemp(prefix="needlens-feed-")
    with open(os.path.join(d, "topic_defi.json"), "w") as f:
        json.dump(FEED, f, indent=2)
    return d


def test_task_feed_fixture_rows(spark, feed_dir):
    posts, states = read_task_feed(spark, feed_dir, whole_files=True)
    got = {r["post_id"]: r for r in collect(good_posts(posts)).collect()}
    assert set(got) == {"n-11", "n-12", "7"}
    p1, p2 = got["n-11"], got["n-12"]
    assert (p1["network"], p1["sentiment_lc"], p1["interactions"], p1["topic"]) == ("tweet", 50.0, 64, "defi")
    assert str(p1["timestamp"]) == "2024-03-01 10:00:00"
    assert (p2["network"], p2["sentiment_lc"], p2["interactions"]) == ("youtube", 20.0, 21)
    assert got["7"]["sentiment_lc"] == 50.0 and str(got["7"]["timestamp"]) == "2024-01-01 00:00:00"
    assert posts.where("not _ok").count() == 1  # the unreadable timestamp
    st = {r["topic"]: r["velocity"] for r in states.collect()}
    assert st == {"defi": 0.1, "rate_cuts": None}


def test_topic_file_by_normalised_name(spark, feed_dir):
    posts, states = read_topic_feed(spark, feed_dir, "Rate-Cuts", whole_files=True)
    got = {r["post_id"]: r["topic"] for r in good_posts(posts).collect()}
    assert got == {"n-11": "Rate-Cuts", "7": "Rate-Cuts"}
    with pytest.raises(ValueError):
        read_topic_feed(spark, feed_dir, "nothing", whole_files=True)


def test_single_topic_shape(spark):
    d = tempfile.mkdtemp(prefix="needlens-feed-")
    doc = {"data": {"task_id": "t", "topic": "oil", "state": {"velocity": -0.2},
                    "posts": [{"id": 1, "post_title": "Oil prices keep rising every single week"}]}}
    with open(os.path.join(d, "topic_oil.json"), "w") as f:
        json.dump(doc, f)
    posts, states = read_topic_feed(spark, d, "oil", whole_files=True)
    assert [r["topic"] for r in good_posts(posts).collect()] == ["oil"]
    assert states.first()["velocity"] == -0.2


def test_flat_feed_fallbacks(spark):
    d = tempfile.mkdtemp(prefix="needlens-feed-")
    doc = {"data": [{"id": 1, "body": "", "text": "Text wins when body is empty", "post_type": "twitter-post",
                     "created_at": "2024-02-01T10:00:00", "sentiment": 3.5, "user_id": "u9", "interactions": 4},
                    {"id": 2, "title": "Only a title here", "network": "reddit", "time": 1705312800}]}
    with open(os.path.join(d, "flat.json"), "w") as f:
        json.dump(doc, f)
    got = {r["post_id"]: r for r in read_flat_feed(spark, d, "btc", whole_files=True).collect()}
    a, b = got["1"], got["2"]
    assert (a["text"], a["network"], a["sentiment_lc"], a["creator_id"], a["interactions"]) == (
        "Text wins when body is empty", "twitter", 3.5, "u9", 4)
    assert str(a["timestamp"]) == "2024-02-01 10:00:00"
    assert (b["text"], b["network"], b["sentiment_lc"]) == ("Only a title here", "reddit", 50.0)
    assert str(b["timestamp"]) == "2024-01-15 10:00:00"


def test_flat_feed_malformed_posts(spark):
    """P7 on the flat feed: a value that is chosen but can't be read."""
    rows = [{"id": "good", "body": "some text", "post_type": "forum-post", "sentiment": "61"},
            {"id": "sent", "body": "some text", "post_sentiment": "high", "sentiment": 40},
            {"id": "type", "body": "some text", "post_type": None},
            {"id": "net", "body": "some text", "network": "blog", "post_type": None},
            {"id": "text", "body": ["a list"], "title": "a title"},
            {"id": "count", "body": "some text", "interactions_24h": "many", "interactions": 3},
            {"id": "next", "body": "some text", "interactions_24h": 0, "interactions": 3},
            {"id": "follow", "body": "some text", "creator_followers": "few"},
            {"id": "bare"}]
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "flat.json"), "w") as f:
        json.dump({"data": rows}, f)
    out = read_flat_feed(spark, d, "btc", whole_files=True)
    assert {r["post_id"] for r in out.where("_ok").collect()} == {"good", "net", "next", "bare"}
    got = {r["post_id"]: r for r in good_posts(out).collect()}
    assert got["good"]["sentiment_lc"] == 61.0 and got["good"]["network"] == "forum"
    assert got["net"]["network"] == "blog" and got["next"]["interactions"] == 3
    assert got["bare"]["network"] == "unknown" and got["bare"]["text"] == ""


def test_topic_file_reads_exactly_its_file(spark, feed_dir):
    from needlens.sources.feeds import read_topic_file
    with open(os.path.join(feed_dir, "topic_oil.json"), "w") as f:
        json.dump({"data": {"topic": "oil", "posts": [{"id": 1, "post_title": "Oil prices keep rising every single week"}]}}, f)
    posts, _ = read_topic_file(spark, feed_dir, "defi")
    assert {r["post_id"] for r in good_posts(posts).collect()} == {"n-11", "n-12", "short"}
    posts, _ = read_topic_file(spark, feed_dir, "oil")
    assert [r["post_id"] for r in good_posts(posts).collect()] == ["1"]
    with pytest.raises(Exception):
        read_topic_file(spark, feed_dir, "gas")


def test_the_posts_of_a_topic_are_never_broadcast(spark):
    """The one state goes to the posts, whatever sizes Spark estimates."""
    import re

    from conftest import SF_SMALL
    from needlens.plans.queries import QUERIES
    plan = QUERIES["single_topic_feed"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert re.findall(r"BroadcastHashJoin \[topic#\d+\], \[topic#\d+\], Inner, (\w+)", plan) == ["BuildRight"]
