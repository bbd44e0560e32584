import numpy as np
from pyspark.sql import functions as F

from needlens.llm import exact_dedup as X
from needlens.llm import fuse


def test_fuse_filter():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 500, 5000, 60000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        f = fuse.build(keys)
        assert fuse.contains(f, keys).all()
        others = rng.integers(0, 2**64, 20000, dtype=np.uint64)
        assert fuse.contains(f, others).mean() < 0.02
    assert len(f["prints"]) < 1.3 * n


CASES = [(1, "a", "x"), (2, "a", "x"), (3, None, "x"), (4, "", None), (5, "b" * 200000, "y"), (6, "b" * 200000, "y"),
         (7, "c", "z"), (7, "c", "z"), (None, "c", "z"), (None, "d", "z"), (None, "d", "z"), (8, "e ", "q"), (9, "e", "q"),
         (10, "same", "1"), (11, "same", "2"), (12, "same", "3"), (13, "same", "4")]


def _check(spark, **kw):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, digest string")
    got = X.exact_dedup(docs, **kw).collect()
    groups = {}
    for i, t, _ in CASES:
        groups.setdefault(t or "", []).append(i)
    want = sorted((str(i), str(max([x for x in g if x is not None], default=None)), len(g)) for g in groups.values() for i in g)
    assert sorted((str(r.id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_cases(spark):
    _check(spark)


def test_equal_digests_of_different_texts_stay_apart(spark):
    _check(spark, digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 2)))
    _check(spark, digest=lambda t: F.unhex(F.lit("00")))


def test_keep_one(spark):
    docs = spark.createDataFrame(CASES, "doc_id long, text string, digest string")
    kept = X.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == [
        (0, "d"), (2, "a"), (4, ""), (6, "bbbbb"), (7, "c"), (8, "e "), (9, "e"), (13, "same")]
    assert X.keep_one(docs.limit(0)).count() == 0
    assert X.exact_dedup(docs.limit(0)).count() == 0
