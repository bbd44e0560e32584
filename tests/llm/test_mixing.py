import re

from pyspark.sql import functions as F

from needlens.llm import mixing as M


def _targets(sizes, share=1.5, cap=2):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, full = {}, set()
    total = share * sum(sizes.values())
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = sum(w[s] for s in order if s not in full)
        goal = {s: cap * sizes[s] if s in full else w[s] * rest / open_ for s in order}
        new = {s for s in order if goal[s] > cap * sizes[s]}
        if not new:
            return goal
        full |= new


def _check(docs, got):
    rows = {}
    for r in docs.collect():
        rows.setdefault(r.source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    sizes = {s: sum(x) for s, x in rows.items()}
    goal = _targets(sizes)
    ids = {r.doc_id: r for r in docs.collect()}
    taken = {}
    for r in got:
        s = ids[r.doc_id].source
        assert r.source_size == sizes[s] and abs(r.target - goal[s]) <= 1e-6 * max(1, goal[s])
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", ids[r.doc_id].text or ""))
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in goal:
        assert abs(taken[s] - goal[s]) <= max(rows[s]) / 2 + 1, (s, taken[s], goal[s])


def test_documents(spark):
    d = "/root/testdata/sf0.01"
    a = M.op3_mixing(spark, d).collect()
    _check(spark.read.parquet(d + "/documents.parquet"), a)
    b = M.op3_mixing(spark, d).collect()
    assert sorted(a) == sorted(b)


def test_cases(spark, tmp_path):
    rows = [(i, "w " * (i % 97 + 1), None if i % 3 == 0 else f"s{i % 5}", "x") for i in range(400)]
    rows += [(2000 + i, "w " * (i * i + 1), f"few{i % 9}", "x") for i in range(40)]
    rows += [(1000, None, "s1", "x"), (1001, "", "none", "x"), (1002, "word " * 30000, "é", "x"), (1003, "a", "\U00020000", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    _check(docs, M.op3_mixing(spark, str(tmp_path)).collect())
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    want = {r.doc_id: r.copies for r in M.op3_mixing(spark, str(tmp_path)).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want
    twice = docs.unionByName(docs.where("doc_id < 50"))
    assert M.mix(twice).count() > 0
    assert M.mix(docs.limit(0)).count() == 0
