"""Exact duplicates against immutable snapshots (operator 4).

A snapshot is an immutable store of distinct texts with one static binary-fuse
filter per digest bucket.  A new batch is compared in three steps:

* its own duplicates are grouped separately (digest and whole text are the
  grouping key, merged map-side, so a text that fills a third of the batch is
  one row per task before the shuffle);
* the distinct digests are screened by the filter of their bucket (a bucket
  holds a bounded number of digests, since the number of buckets follows the
  row count);
* only positives join the exact bucket of the snapshot, on digest *and* text,
  which compares the bytes.

``exact_dedup`` runs a whole table that way: one part becomes the first
snapshot, the other part the incoming batch.

Defined results: null text counts as empty.  The row with the largest id stays;
a null id is smaller than any other.  Of rows that repeat an id and its text,
one stays.  Two texts with equal digest but different bytes stay apart.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needlens.llm import fuse
from needlens.llm.shared import packed, quoted, staged

KEYS_PER_BUCKET = 2048

FILTER_SCHEMA = "bucket int, seed int, seg int, starts int, prints binary"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _bucket(digest: Column, n: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), F.lit(n)).cast("int")


def _keys(digests) -> np.ndarray:
    raw = b"".join(bytes(d)[:8].ljust(8, b"\0") for d in digests)
    return np.frombuffer(raw, dtype="<u8")


def _build_filter(pdf: pd.DataFrame) -> pd.DataFrame:
    f = fuse.build(_keys(pdf["digest"]))
    return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], **f}])


def _screen(digests: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(digests) or not len(filters):
        return digests.iloc[:0][["digest"]]
    hit = fuse.contains(filters.iloc[0].to_dict(), _keys(digests["digest"]))
    return digests.loc[hit, ["digest"]]


def distinct_texts(rows: DataFrame) -> DataFrame:
    """Rows (digest, tag, text) grouped by digest and whole text."""
    return rows.groupBy("digest", "tag", "text").agg(F.count(F.lit(1)).alias("n"))


def write_snapshot(texts: DataFrame, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """Immutable store of distinct texts and its filter table."""
    store = staged(texts.withColumn("bucket", _bucket(F.col("digest"), n_buckets))
                        .withColumn("class", F.monotonically_increasing_id()), "dedup-store")
    filters = staged(store.select("bucket", "digest").distinct().groupBy("bucket")
                          .applyInPandas(_build_filter, FILTER_SCHEMA), "dedup-filters")
    return store, filters


def screen(digests: DataFrame, filters: DataFrame, n_buckets: int) -> DataFrame:
    """The distinct ``digests`` that the snapshot perhaps holds."""
    keyed = digests.withColumn("bucket", _bucket(F.col("digest"), n_buckets))
    return (keyed.groupBy("bucket").cogroup(filters.groupBy("bucket"))
                 .applyInPandas(_screen, "digest binary"))


def _rows(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    return docs.select(F.col(quoted(id_col)).alias("id"), F.monotonically_increasing_id().alias("rid"),
                       text.alias("text"), digest(text).alias("digest"),
                       F.xxhash64(text).alias("tag"),
                       F.pmod(F.xxhash64(F.col(quoted(id_col))), F.lit(2)).alias("part"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest=sha256, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """One row per document: ``id, rid, digest, keep_id, group_size, kept``.

    Half of the rows (by a hash of the id) form the first snapshot, the other
    half is the incoming batch.
    """
    rows = _rows(docs, id_col, text_col, digest)
    keys = staged(rows.select("id", "rid", "digest", "tag", "part"), "dedup-keys")
    n_buckets = max(1, -(-keys.count() // (2 * keys_per_bucket)))
    texts = rows.select("digest", "tag", "text", "part")
    store, filters = write_snapshot(distinct_texts(texts.where("part = 0")), n_buckets)
    maybe = staged(screen(keys.where("part = 1").select("digest").distinct(), filters, n_buckets),
                   "dedup-positives")
    exact = store.join(maybe, "digest", "left_semi").select("digest", "text", "class")
    fresh = distinct_texts(texts.where("part = 1"))
    matched = (fresh.join(exact.withColumnRenamed("class", "old"), ["digest", "text"], "left")
                    .select("digest", "tag", "n", F.coalesce(
                        "old", -F.lit(1) - F.monotonically_increasing_id()).alias("class")))
    classes = matched.unionByName(store.select("digest", "tag", "n", "class"))
    top = keys.groupBy("digest", "tag").agg(F.max(F.struct("id", "rid")).alias("top"))
    classes = (classes.groupBy("digest", "tag")
                      .agg(F.sum("n").alias("group_size"), F.min("class").alias("a"), F.max("class").alias("b"))
                      .withColumn("group_size", F.when(F.col("a") == F.col("b"), F.col("group_size")).otherwise(
                          F.raise_error(F.lit("two texts share their digest and their second hash"))))
                      .join(top, ["digest", "tag"])
                      .select("digest", "tag", "group_size", "top"))
    classes = staged(classes, "dedup-classes")
    out = keys.join(classes, ["digest", "tag"])
    return out.select("id", "rid", "digest", F.col("top.id").alias("keep_id"), "group_size",
                      (F.col("rid") == F.col("top.rid")).alias("kept"))


def row_key(row_id: Column, digest: Column) -> Column:
    """Id and text digest as one value; a null id is a value of its own."""
    return F.concat(F.hex(digest), F.coalesce(F.concat(F.lit("i"), row_id.cast("string")), F.lit("-")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.  Of rows that repeat an
    id and its text one stays."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(row_key(F.col("id"), F.col("digest")).alias("key"))
    digest = sha256(F.coalesce(F.col(quoted(text_col)), F.lit("")))
    rows = packed(docs, row_key(F.col(quoted(id_col)), digest).alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def op4_exact_dedup(spark, sf_dir):
    """Contract query: every document with the row of its text that stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))"""
