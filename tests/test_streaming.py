"""Streaming ingest gives the same posts as the batch reader."""

import os
import tempfile

from needlens.plans.collect import collect
from needlens.sources.feeds import documents_as_task_feed, good_posts, read_task_feed
from needlens.streaming.ingest import run_once

from conftest import SF_SMALL


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="needlens-stream-")
    feed, out = os.path.join(base, "feed"), os.path.join(base, "out")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    documents_as_task_feed(docs).write.text(feed)
    run_once(spark, feed, out, checkpoint=os.path.join(base, "ckpt"))
    streamed = {r["post_id"] for r in spark.read.parquet(out).select("post_id").collect()}
    posts, _ = read_task_feed(spark, feed)
    batch = {r["post_id"] for r in collect(good_posts(posts)).select("post_id").collect()}
    assert streamed == batch and len(batch) > 0
