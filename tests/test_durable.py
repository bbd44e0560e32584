"""Versioned results (K1, K3), durable answers (K4, C8), restartable runs (S8, R1) and
approximate radius joins (J5)."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from needlens.operators import lsh
from needlens.operators.answerlog import answer_durably, stored_answers
from needlens.operators.versions import ResultTable, VersionTaken
from needlens.plans.stagelog import StageLog

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, writes):
    return spark.createDataFrame([(k, v, T0 + dt.timedelta(hours=h), T0 + dt.timedelta(hours=h + ttl), s)
                                  for s, (k, v, h, ttl) in enumerate(writes)],
                                 "cache_key string, value string, written_at timestamp, expires timestamp, seq long")


def _values(df):
    return sorted((r.cache_key, r.value) for r in df.collect())


def test_readers_see_one_version(spark, tmp_path):
    t = ResultTable(spark, f"{tmp_path}/t", buckets=3)
    assert t.versions() == [] and t.read().count() == 0
    t.put(_rows(spark, [("a", "1", 0, 24), ("b", "2", 0, 1)]))
    before = t.version()
    reader = t.read(before)
    t.put(_rows(spark, [("a", "3", 2, 24)]))
    now = F.lit(T0 + dt.timedelta(hours=3))
    assert _values(t.fresh(now)) == [("a", "3")]
    purged = t.purge(now)
    assert _values(t.read()) == [("a", "1"), ("a", "3")] and purged.number == 3 and len(purged.commits) == 1
    assert _values(reader) == [("a", "1"), ("b", "2")]  # the version that was opened, during and after the purge
    t.compact()
    assert _values(t.read()) == [("a", "3")]
    assert _values(t.read(before)) == [("a", "1"), ("b", "2")]
    gone = t.vacuum()
    assert len(gone) == 3 and t.versions() == [4] and _values(t.read()) == [("a", "3")]


def test_half_written_versions_are_not_read(spark, tmp_path):
    t = ResultTable(spark, f"{tmp_path}/t", buckets=2)
    t.put(_rows(spark, [("a", "1", 0, 24)]))
    t._write(_rows(spark, [("a", "lost", 1, 24)]))  # a writer that died before its manifest
    with open(f"{tmp_path}/t/versions/.half", "w") as f:
        f.write('{"commits": ["no')
    assert _values(t.read()) == [("a", "1")] and t.versions() == [1]
    assert t.put(_rows(spark, [("b", "2", 0, 24)])).number == 2
    assert _values(t.read()) == [("a", "1"), ("b", "2")]
    assert len(t.vacuum(keep=2)) == 1  # the data without a manifest


def test_a_purge_does_not_lose_a_put_made_meanwhile(spark, tmp_path, monkeypatch):
    t = ResultTable(spark, f"{tmp_path}/t", buckets=2)
    t.put(_rows(spark, [("a", "1", 0, 1)]))
    publish, meanwhile = ResultTable._publish, []

    def slow(self, base, commits):
        if not meanwhile:
            meanwhile.append(1)
            publish(self, base, (*base.commits, self._write(_rows(spark, [("b", "2", 0, 24)]))))
        return publish(self, base, commits)
    monkeypatch.setattr(ResultTable, "_publish", slow)
    t.purge(F.lit(T0 + dt.timedelta(hours=5)), spark.createDataFrame([("z",)], "cache_key string"))
    assert _values(t.read()) == [("b", "2")]
    with pytest.raises(VersionTaken):
        publish(t, t.version(1), ())


def test_a_killed_run_asks_only_for_what_is_missing(spark, tmp_path):
    log, asked = f"{tmp_path}/log", str(tmp_path / "asked")
    df = spark.createDataFrame([(i, f"prompt {i % 40}") for i in range(60)] + [(99, None)], "id long, prompt string")

    def dying(prompts):
        import os
        with open(asked, "a") as f:
            f.write("".join(p + "\n" for p in prompts))
        if sum(1 for _ in open(asked)) > 25:
            os._exit(1)  # the worker dies in the middle
        return [p.upper() for p in prompts]

    def working(prompts):
        with open(asked, "a") as f:
            f.write("".join(p + "\n" for p in prompts))
        return [p.upper() for p in prompts]
    with pytest.raises(Exception):
        answer_durably(df, "prompt", dying, log, in_flight=1, batch_size=5, tries=1).collect()
    done = {r.answer for r in stored_answers(spark, log).collect()}
    assert 20 <= len(done) < 41
    open(asked, "w").close()
    got = answer_durably(df, "prompt", working, log, in_flight=2, batch_size=5).collect()
    again = open(asked).read().split("\n")[:-1]
    assert len(again) == 41 - len(done) and not {p.upper() for p in again} & done
    assert len(got) == 61 and all(r.answer == (r.prompt or "").upper() and r.error is None for r in got)
    assert sum(os.path.basename(f).startswith(".") and f.endswith(".parquet") for f in os.listdir(log)) == 0


def test_failed_prompts_are_asked_again(spark, tmp_path):
    log = f"{tmp_path}/log"
    df = spark.createDataFrame([("good",), ("bad",)], "prompt string")

    def some(prompts):
        if "bad" in prompts:
            raise RuntimeError("no")
        return ["fine"] * len(prompts)
    first = {r.prompt: (r.answer, r.error) for r in answer_durably(df, "prompt", some, log, tries=1).collect()}
    assert first["good"] == ("fine", None) and first["bad"][0] is None and first["bad"][1].startswith("RuntimeError")
    second = {r.prompt: r.answer for r in answer_durably(df, "prompt", lambda p: ["late"] * len(p), log).collect()}
    assert second == {"good": "fine", "bad": "late"}


def test_a_run_goes_on_after_its_last_stage(spark, tmp_path):
    built = []

    def table(name, rows, read=None):
        def build():
            built.append(name)
            return spark.range(rows) if read is None else read().limit(rows)
        return build
    log = StageLog(spark, str(tmp_path), "r1", "feed of monday")
    one = log.stage("one", table("one", 10))
    log.stage("two", table("two", 5, lambda: one))
    log.consumed("one")
    assert log.tables() == ["two"] and log.rows("one") == 10
    log = StageLog(spark, str(tmp_path), "r1", "feed of monday")  # the run was killed here
    assert log.stage("two", table("two", 5)).count() == 5 and log.stage("three", table("three", 3)).count() == 3
    assert built == ["one", "two", "three"]
    other = StageLog(spark, str(tmp_path), "r1", "feed of tuesday")
    assert not other.finished("one") and other.stage("one", table("one", 4)).count() == 4


def test_recall_model_and_measured_recall(spark):
    rng = np.random.default_rng(3)
    assert lsh.collision(0, 2) == 1 and abs(lsh.collision(1.0, 1.0) - 0.3687) < 1e-3
    assert lsh.expected_recall(1.0, 2.0, 4, lsh.tables_for(1.0, 2.0, 4, 0.9)) >= 0.9
    x = np.concatenate([rng.normal(size=(400, 16)) * 4, np.zeros((3, 16))])
    x = np.concatenate([x, x[:200] + rng.normal(size=(200, 16)) * 0.2])
    df = spark.createDataFrame([(i, [float(e) for e in v]) for i, v in enumerate(x)], "id long, v array<double>")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = {(i, j) for i, j in zip(*np.nonzero(d <= 1.2)) if i < j}
    rows = lsh.radius_pairs_lsh(df, "id", "v", 1.2, recall=0.95, block=7).collect()
    got = {(r.id_a, r.id_b) for r in rows}
    assert len(rows) == len(got) and got <= want and len(got) >= 0.9 * len(want) and len(want) > 150
    assert all(abs(r.dist - d[r.id_a, r.id_b]) < 1e-9 for r in rows)


def test_more_topics_than_fit_in_packed_numbers(spark, tmp_path):
    import json
    from needlens.sources.feeds import good_posts, read_task_feed
    topics = [{"topic": f"t{k}", "posts": [{"id": f"{k}-{i}", "post_title": "a post that is long enough to stay"} for i in range(2)]}
              for k in range(5000)]
    with open(tmp_path / "feed.json", "w") as f:
        f.write(json.dumps({"data": {"seq": 1, "topics": topics}}) + "\n" + json.dumps({"data": {"seq": 0, "topics": topics[:3]}}) + "\n")
    posts, states = read_task_feed(spark, str(tmp_path / "feed.json"))
    rows = good_posts(posts).select("ord", "post_id").orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(10_006))
    assert [r.post_id for r in rows[:7]] == ["0-0", "0-1", "1-0", "1-1", "2-0", "2-1", "0-0"] and rows[-1].post_id == "4999-1"
    assert states.count() == 5000


def test_metrics_of_an_empty_run(spark):
    from needlens.plans.run import run
    posts = spark.createDataFrame([], "post_id string, text string, creator_id string, network string, topic string, ord long")
    res = run(posts)
    assert res.specs is None and {(r.metric, r.value) for r in res.metrics.collect()} == {
        ("raw", 0), ("short", 0), ("non_latin", 0), ("kept", 0), ("unique", 0)}


def test_a_bucket_is_compared_as_a_whole():
    """Rows of a bucket that arrive in several batches: the pairs of all its points, but for those that met in an
    earlier table, some rows at a time."""
    import pyarrow as pa
    rng = np.random.default_rng(8)
    n, dim = 1200, 5
    x, ids = rng.normal(size=(n, dim)), rng.permutation(10 * n)[:n]
    keys = np.stack([rng.integers(0, 4, n), np.zeros(n, int)], 1)
    side = np.where(np.arange(n) % 2 == 0, 0, 1)

    def rows(t, j, side):
        return pa.table({"t": [t] * n, "key": [7] * n, "i": [0] * n, "j": [j] * n, "side": side, "id": ids,
                         "vec": [v.astype("<f8").tobytes() for v in x], "all": [k.astype("<i8").tobytes() for k in keys]})
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    table = pa.concat_tables([rows(1, 0, np.full(n, 2)), rows(1, 1, side)])
    got = [r for b in lsh._bucket_pairs(1.5, 2, dim)(table.to_batches(max_chunksize=500)) for r in b.to_pylist()]
    i, j = np.nonzero(np.triu((d <= 1.5) & (keys[:, None, 0] != keys[None, :, 0]), 1))
    own = [(min(ids[a], ids[b]), max(ids[a], ids[b]), d[a, b]) for a, b in zip(i, j)]
    across = [(p, q, w) for (p, q, w), a, b in zip(own, i, j) if side[a] != side[b]]
    assert sorted((r["id_a"], r["id_b"], r["dist"]) for r in got) == sorted(own + across) and len(across) > 1000


def test_embedding_leaves_the_other_columns_alone(spark):
    from needlens.operators.embed import embed_with
    ids = [2 ** 60 + 1, None, 3]

    def lengths(texts):
        assert len(texts) <= 2
        return [[len(t), 1] for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in zip(ids, ("four", None, ""))], "ord long, text string").coalesce(1)
    got = embed_with(df, "text", lengths, batch_size=2).collect()
    assert [(r.ord, r.text, r.embedding) for r in got] == [(ids[0], "four", [4, 1]), (None, None, [0, 1]), (3, "", [0, 1])]
