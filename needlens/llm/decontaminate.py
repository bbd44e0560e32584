"""Benchmark decontamination by hashed word windows (operator 13).

1. The benchmark's normalised texts are cut into windows of ``n`` words (an item
   of fewer words is one window); the distinct windows, their hashes and their
   items form a table.
2. If that table stays below ``BROADCAST_BYTES`` it is broadcast whole.  A larger
   one is dealt by hash into shards below that size, which are broadcast and
   scanned one after the other.  The documents are never shuffled for the scan.
3. A document is scanned as bytes: words by a lookup table, word and window
   hashes by numpy over a slice of documents.  A window whose hash is in the set
   is verified against the words themselves, so hash collisions cost time only.
4. The hit words are marked, or their spans or whole documents are removed.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, that is
runs of ASCII letters and digits and of anything beyond ASCII.

Defined results: null text has no words; an item without words has no windows; a
null item id counts as the empty string; items that repeat an id count once.
Rows that repeat a document stay rows of their own.  An empty benchmark hits
nothing.  Extra columns are kept by ``decontaminate`` and passed over by
``find_hits``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from needlens.llm.shared import drop_stage, staged, text_slices

WINDOW = 10
BROADCAST_BYTES = 32 << 20  # of one broadcast shard of windows
SLICE = 1 << 20  # bytes scanned together, about

_BLANK = 32
#: Byte to normalised byte: lower-case letters, digits and bytes beyond ASCII stay.
NORMAL = np.array([b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else _BLANK
                   for b in range(256)], np.uint8)
_BYTE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xC2B2AE3D27D4EB4F)


# --- words and their hashes ---------------------------------------------------------

def _inverse(m: np.uint64) -> np.uint64:
    """The inverse of an odd number modulo 2 ** 64."""
    return np.uint64(pow(int(m), -1, 1 << 64))


def _powers(m: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, m, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of texts laid end to end: normalised bytes, where each word begins
    and ends, its hash, and the words of each text (``first`` to ``last``)."""

    def __init__(self, raw: np.ndarray, text_ends: np.ndarray):
        self.bytes = NORMAL[raw]
        solid = self.bytes != _BLANK
        new = np.zeros(len(raw) + 1, bool)  # a text ends the word before it
        new[text_ends] = True
        before = np.concatenate(([False], solid[:-1])) if len(raw) else solid
        self.begin = np.flatnonzero(solid & (~before | new[:-1]))
        after = np.concatenate((solid[1:], [False])) if len(raw) else solid
        self.end = np.flatnonzero(solid & (~after | new[1:])) + 1
        self.last = np.searchsorted(self.begin, text_ends)
        self.first = np.concatenate(([0], self.last[:-1]))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomial hashes by prefix sums, in pieces of bounded size."""
        out = np.empty(len(self.begin), np.uint64)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.end, self.begin[at] + SLICE, side="right")))
            x, y = self.begin[at], self.end[to - 1]
            up = _powers(_BYTE, y - x)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.bytes[x:y].astype(np.uint64) + np.uint64(1)) * up)))
            b, e = self.begin[at:to] - x, self.end[at:to] - x
            out[at:to] = _mix((sums[e] - sums[b]) * _powers(_inverse(_BYTE), y - x)[b])
            at = to
        return out

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words (also those across two texts)."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out *= _WORD
            out += self.hash[k:k + n]
        return _mix(out + np.uint64(size))

    def text(self, at: int, size: int) -> bytes:
        """The normalised words from ``at`` on, joined by a blank."""
        return b" ".join(self.bytes[self.begin[at]:self.end[at + size - 1]].tobytes().split())


# --- the benchmark's windows ----------------------------------------------------------

def _windows_of(n):
    def run(batches):
        for ids, _, raw, ends in text_slices(batches, "text", ("item",), SLICE):
            words, out = Words(raw, ends), []
            for item, x, y in zip(ids.to_pylist(), words.first.tolist(), words.last.tolist()):
                size = min(n, y - x)
                if size:
                    h = words.windows(size)
                    out += [(int(h[k:k + 1].view(np.int64)[0]), size, words.text(k, size), item)
                            for k in range(x, y - size + 1)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.string()))],
                    ["hash", "size", "words", "item"])
    return run


def windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``hash, size, words, item`` of the benchmark's windows."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_windows_of(n), "hash long, size int, words binary, item string").distinct()


def shards(table: DataFrame, most: int) -> int:
    """Number of shards of at most about ``most`` bytes that the table needs."""
    size = table.agg(F.sum(F.octet_length("words") + F.octet_length("item") + 64)).first()[0] or 0
    return max(1, -(-size // most))


# --- scanning -------------------------------------------------------------------------

class WindowSet:
    """The windows of one shard: a hash screen by size, then exact words."""

    def __init__(self, rows):
        self.items, sizes = {}, {}
        for h, size, words, item in rows:
            self.items.setdefault((size, words), []).append(item)
            sizes.setdefault(size, set()).add(h)
        self.known = {s: np.sort(np.fromiter(h, np.int64, len(h)).view(np.uint64)) for s, h in sorted(sizes.items())}
        self.screen = {}
        for s, h in self.known.items():
            bits = min(24, max(16, (16 * len(h)).bit_length()))
            table = np.zeros(1 << bits, bool)
            table[h >> np.uint64(64 - bits)] = True
            self.screen[s] = np.uint64(64 - bits), table

    def hits(self, words: Words):
        """Verified windows as (first word, size, items), by size and place."""
        for size, known in self.known.items():
            h = words.windows(size)
            shift, table = self.screen[size]
            maybe = np.flatnonzero(table[h >> shift])
            at = np.searchsorted(known, h[maybe])
            maybe = maybe[known[np.minimum(at, len(known) - 1)] == h[maybe]]
            whole = words.last[np.searchsorted(words.last, maybe, side="right")] >= maybe + size
            for k in maybe[whole].tolist():
                items = self.items.get((size, words.text(k, size)))
                if items:
                    yield k, size, items


_HITS = "key long, n_words long, first array<long>, last array<long>, begin array<long>, end array<long>, items array<string>"


def _scanner(shared, only_hits):
    def run(batches):
        known = WindowSet(shared.value)
        for keys, _, raw, ends in text_slices(batches, "text", ("key",), SLICE):
            words = Words(raw, ends)
            begins = np.concatenate(([0], ends[:-1]))
            mark = np.zeros(len(words.hash) + 1, np.int64)
            items = {}
            for k, size, names in known.hits(words):
                mark[k] += 1
                mark[k + size] -= 1
                items.setdefault(int(np.searchsorted(words.last, k, side="right")), set()).update(names)
            hit = np.cumsum(mark[:-1]) > 0
            out = []
            for d, key in enumerate(keys.to_pylist()):
                x, y = int(words.first[d]), int(words.last[d])
                if d not in items:
                    if not only_hits:
                        out.append((key, y - x, [], [], [], [], []))
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[x:y].astype(np.int8), [0]))))
                a, b = edge[::2], edge[1::2]  # runs of hit words
                out.append((key, y - x, a.tolist(), b.tolist(), (words.begin[x + a] - begins[d]).tolist(),
                            (words.end[x + b - 1] - begins[d]).tolist(), sorted(items[d])))
            if out:
                longs = pa.list_(pa.int64())
                kinds = (pa.int64(), pa.int64(), longs, longs, longs, longs, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["key", "n_words", "first", "last", "begin", "end", "items"])
    return run


def _united(batches):
    """Spans and items of a document found in several shards, united."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            spans = []
            for span in sorted(zip(*(row[c] for c in ("first", "last", "begin", "end")))):
                if spans and span[0] <= spans[-1][1]:
                    if span[1] > spans[-1][1]:
                        spans[-1] = (spans[-1][0], span[1], spans[-1][2], span[3])
                else:
                    spans.append(span)
            for c, values in zip(("first", "last", "begin", "end"), zip(*spans) if spans else [[]] * 4):
                row[c] = list(values)
            row["items"] = sorted(set(row["items"]))
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def scan(rows: DataFrame, table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Hits of ``rows`` (key, text) for the windows of ``table``: one row a key,
    with the runs of hit words (``first`` to ``last`` in words, ``begin`` to
    ``end`` in bytes) and the items.  ``key`` must be unique if the table needs
    several shards."""
    spark, n = rows.sparkSession, shards(table, most)

    def shared(part):
        got = part.collect()  # below the size checked by shards()
        return spark.sparkContext.broadcast([(r["hash"], r["size"], bytes(r["words"]), r["item"]) for r in got])
    if n == 1:
        return rows.mapInArrow(_scanner(shared(table), False), _HITS)
    found = []
    for k in range(n):
        part = table.where(F.pmod(F.xxhash64("hash"), F.lit(n)) == k)
        found.append(staged(rows.mapInArrow(_scanner(shared(part), True), _HITS), f"decontaminate-{k}"))
    every = rows.mapInArrow(_scanner(spark.sparkContext.broadcast([]), False), _HITS)
    for f in found:
        every = every.unionByName(f)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("first", "last", "begin", "end", "items")]
    return every.groupBy("key").agg(F.max("n_words").alias("n_words"), *lists).mapInArrow(_united, _HITS)


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
              most: int = BROADCAST_BYTES) -> DataFrame:
    """``key, n_words, first, last, begin, end, items`` of every document; ``key`` is
    the id (as long)."""
    table = staged(windows(benchmark, n), "decontaminate-windows")
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    if shards(table, most) == 1:
        return scan(rows, table, most)
    rows = staged(rows.withColumn("rid", F.monotonically_increasing_id()), "decontaminate-rows")
    found = scan(rows.select(F.col("rid").alias("key"), "text"), table, most).withColumnRenamed("key", "rid")
    return rows.select("rid", "key").join(found, "rid").drop("rid")


def _cut(batches):
    for batch in batches:
        out = []
        for text, begin, end in zip(*(batch.column(c).to_pylist() for c in ("text", "begin", "end"))):
            if text is not None and begin:
                raw, at, kept = text.encode(), 0, []
                for x, y in zip(begin, end):
                    kept.append(raw[at:x])
                    at = y
                text = b"".join([*kept, raw[at:]]).decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", share: float = 0.0,
                  n: int = WINDOW, text_col: str = "text", most: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the benchmark's passages, columns unchanged.

    ``remove="spans"`` cuts the runs of hit words out of the texts;
    ``remove="documents"`` drops documents of whose words more than ``share`` are hit.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown way to remove: {remove!r}")
    table = staged(windows(benchmark, n), "decontaminate-windows")
    rows = staged(docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
                      .withColumn("key", F.monotonically_increasing_id()), "decontaminate-rows")
    hits = staged(scan(rows.select("key", "text"), table, most).where(F.size("first") > 0), "decontaminate-hits")
    drop_stage(table)
    if remove == "documents":
        words = F.aggregate(F.zip_with("first", "last", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x)
        bad = hits.where(words > F.col("n_words") * F.lit(share)).select("key")
        return rows.join(bad, "key", "left_anti").select("row.*")
    dirty = rows.join(hits.select("key", "begin", "end"), "key")
    cut = dirty.select("row", "text", "begin", "end").mapInArrow(
        _cut, StructType([rows.schema["row"], StructField("text", StringType())]))
    clean = rows.join(hits, "key", "left_anti").select("row", "text")
    back = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return clean.unionByName(cut).select(*back)


def op13_decontaminate(spark, sf_dir):
    """Contract query: words, hit words and items of every document."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    hit = F.aggregate(F.zip_with("first", "last", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x)
    return find_hits(docs.select("doc_id", "text"), benchmark).select(
        F.col("key").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("first") > 0).alias("contaminated"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item, least(WINDOW_SIZE, len(w)) AS size, array_to_string(w[p:p + least(WINDOW_SIZE, len(w)) - 1], ' ') AS words
  FROM i, unnest(range(1, len(w) - least(WINDOW_SIZE, len(w)) + 2)) AS t(p) WHERE len(w) > 0
), s AS (SELECT DISTINCT size FROM g), x AS (
  SELECT rid, p, size, array_to_string(w[p:p + size - 1], ' ') AS words
  FROM d, s, unnest(range(1, len(w) - size + 2)) AS t(p)
), m AS (SELECT rid, p, size, item FROM x JOIN g USING (size, words)
), n AS (
  SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(p, p + size)) AS at FROM m) GROUP BY rid
), k AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN k USING (rid)""".replace("WINDOW_SIZE", str(WINDOW))
