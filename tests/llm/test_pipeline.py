import re
from collections import Counter

import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from needlens.llm import langid, mixing, pieces


def _fp(text):
    words = (text or "").encode().lower().split()
    sh = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64)) if h else 0


def _near(rows):
    """Smallest id of every component of fingerprints within four bits."""
    fps = {}
    for r in rows:
        fps.setdefault(_fp(r[1]), []).append(r[0])
    keys = sorted(fps)
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    best = {}
    for k in keys:
        best[root(k)] = min([best.get(root(k), 1 << 60), *fps[k]])
    return set(best.values())


def test_pipeline_like_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language id", "exact dedup", "simhash near-dedup", "mixing sources to target weights", "sentencepiece encoding"]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    model = langid.fit(docs)
    known = [r for r, g in zip(rows, langid.predict([r[1] or "" for r in rows], model)[0]) if g != "und"]
    last = {}
    for i, t, _ in known:
        last[t] = max(last.get(t, i), i)
    exact = [r for r in known if last[r[1]] == r[0]]
    stay = _near(exact)
    near = [r for r in exact if r[0] in stay]
    encoder = pieces.Encoder(pieces.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    ids = {r[0]: encoder.encode(r[1]).tolist() for r in near}
    got = corpus_pipeline.run(spark, sf).collect()
    assert all(r.piece_ids == ids[r.doc_id] and r.n_pieces == len(r.piece_ids) for r in got)
    times = Counter(r.doc_id for r in got)
    assert max(times.values()) <= 2 and set(times) <= set(ids)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in near}
    by = {}
    for i, _, s in near:
        by.setdefault(s, []).append(i)
    sizes = spark.createDataFrame([(s, size[i], 1) for s, x in by.items() for i in x], "source string, size long, n long")
    goal = {r.source: r.target for r in mixing.targets(sizes).collect()}
    for s, members in by.items():
        taken = sum(times[i] * size[i] for i in members)
        assert abs(taken - goal[s]) <= max(size[i] for i in members) / 2 + 1


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, "---", None, "s", 3)], docs.schema)
    names = ["_text", "_digest", "_id", "rid", "id", "row", "text2 `x`", "digest", "known", "n_pieces", "key"]
    docs = docs.unionByName(odd)
    for n in names:
        docs = docs.withColumn(n, F.lit("clash"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == columns and docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert last.columns == [c for c in columns if c not in ("text", "n_pieces")] + ["n_pieces", "piece_ids"]
    assert last.where("`text2 ``x``` = 'clash'").count() == docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
