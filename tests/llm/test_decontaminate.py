import hashlib
import re

import numpy as np
import pytest

from needlens.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _want(docs, items, n=10):
    seen = {}
    for i, t in items:
        w = _words(t)
        size = min(n, len(w))
        for p in range(len(w) - size + 1 if size else 0):
            seen.setdefault(tuple(w[p:p + size]), set()).add("" if i is None else str(i))
    sizes = {len(k) for k in seen}
    out = []
    for i, t in docs:
        w, hit, found = _words(t), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                got = seen.get(tuple(w[p:p + size]))
                if got:
                    hit.update(range(p, p + size))
                    found |= got
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def _got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


PASSAGE = "One two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, PASSAGE), (2, "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"), (3, "short item"), (4, None), (5, ""),
         (6, "...!"), (7, "漢字 かな"), (None, "null item id"), (10, "short ITEM"), (1, "again with the first id"), (8, "Ünïcode Wörds"),
         (9, "x " * 30)]
DOCS = [(0, None), (1, ""), (2, "---"), (3, PASSAGE), (4, "before " + PASSAGE.upper().replace(" ", ",\n") + " after"),
        (5, "one two three four five six seven eight nine"), (6, "a short-item here"), (6, "a short-item here"), (7, "漢字、かな 漢字 かな"),
        (8, "this null item id and short item"), (None, "short item"), (9, "x " * 9), (10, "x " * 25), (11, "ünïcode wörds ÜNÏCODE wörds"),
        (12, "short"), (13, "item short"), (14, PASSAGE + " " + PASSAGE), (15, "w " * 30000 + PASSAGE + " v" * 30000),
        (16, "short\0item"), (17, "short item"), (18, "shortitem"), (-4, "again with the first id"), (19, "x" * 5000 + " short item")]


@pytest.mark.parametrize("size", [1 << 20, 16])
def test_cases(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(D, "SLICE", size)
    spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, n_words int, key string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, hash string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert _got(D.op13_decontaminate(spark, str(tmp_path))) == _want(DOCS, ITEMS)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/a/benchmark.parquet")
    assert _got(D.op13_decontaminate(spark, f"{tmp_path}/a")) == _want(DOCS, [])
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/b/benchmark.parquet")
    assert _got(D.op13_decontaminate(spark, f"{tmp_path}/b")) == []


def test_shards_give_the_same_hits(spark):
    """A benchmark beyond the broadcast bound is scanned in several shards."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = sorted((str(r.key), r.n_words, r["first"], r["last"], r.begin, r.end, r["items"]) for r in D.find_hits(docs, items).collect())
    assert D.shards(D.windows(items), 300) > 3
    many = sorted((str(r.key), r.n_words, r["first"], r["last"], r.begin, r.end, r["items"]) for r in D.find_hits(docs, items, most=300).collect())
    assert many == one


def test_equal_hashes_of_other_words_do_not_hit(spark, monkeypatch):
    monkeypatch.setattr(D, "_mix", lambda h: h & np.uint64(3))  # nearly all hashes collide
    words = D.Words(np.frombuffer(b"short item other words", np.uint8), np.array([22]))
    rows = [(int(words.windows(2)[0]), 2, b"short item", "3")]
    assert [(k, s) for k, s, _ in D.WindowSet(rows).hits(words)] == [(0, 2)]


def test_removal(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, row string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = D.decontaminate(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(DOCS)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[0] is None and texts[1] == "" and texts[2] == "---" and texts[12] == "short"
    assert texts[3] == "" and texts[4] == "before  after" and texts[6] == "a  here" and texts[15].count("w") == 30000
    assert texts[5] == DOCS[5][1] and texts[8].startswith("this ") and all(r.row == "x" for r in clean.collect())
    kept = D.decontaminate(docs, items, remove="documents")
    assert sorted((str(r.doc_id), len(_words(r.text))) for r in kept.collect()) == sorted(
        (w[0], w[1]) for w in _want(DOCS, ITEMS) if not w[5])
    half = D.decontaminate(docs, items, remove="documents", share=0.5)
    assert half.count() > kept.count()


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert _got(D.op13_decontaminate(spark, sf)) == _want(docs, items)
