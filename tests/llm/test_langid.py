import random
import zlib

from pyspark.sql import functions as F

from needlens.llm import langid as L


def _phrases(text, sample):
    """Greedy longest phrases by substring search."""
    t, i, n = L._letters(text), 0, 0
    while i < len(t):
        k = 1
        while i + k < len(t) and t[i:i + k + 1] in sample:
            k += 1
        i, n = i + k, n + 1
    return n


def test_phrase_counts_like_substring_search():
    rnd = random.Random(3)
    samples = {"a": ["abra cadabra", "bard, cab!"], "b": ["été où là", "zoo zebra"]}
    model = L.train(samples)
    joined = {g: " ".join(L._letters(t) for t in ts) for g, ts in samples.items()}
    texts = ["", " ", "123 !!", "abra", "x", "xx yy", "ÉTÉ zoo", "  ab--cab  ", "aß漢a\U00020000"]
    texts += ["".join(rnd.choice("abcdrzeéoù .X") for _ in range(rnd.randint(1, 1500))) for _ in range(40)]
    got = L.phrase_counts(texts, model)
    assert got.tolist() == [[_phrases(t, joined["a"]), _phrases(t, joined["b"])] for t in texts]
    assert L.predict([], model)[0] == []
    assert L.predict(["abra", "1"], L.train({})) [0] == ["und", "und"]


def test_held_out_accuracy_and_cases(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in L.op5_language_id(spark, "/root/testdata/sf0.01").collect()}
    rows = d.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in held)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    extra = spark.createDataFrame(
        [(None, None, None, "a"), (1, "", None, "b"), (2, "123 --", "en", "c"), (3, "the " * 50000, None, "d"),
         (3, "the " * 50000, None, "d")], "doc_id long, text string, lang string, lang_pred string")
    docs = d.select("doc_id", "text", "lang", F.lit("clash").alias("lang_pred")).unionByName(extra)
    kept = L.keep_known(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) + 2
    assert L.keep_known(docs.limit(0)).count() == 0
