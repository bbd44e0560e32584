"""D3, D4 and the spec/report sinks."""

import os
import tempfile


from needlens.operators.segments import kmeans_segments, merge_topics, user_shares
from needlens.sources import sinks


def test_user_segments_separate_behaviours(spark):
    rows = [(u, "click") for u in range(5) for _ in range(9)] + [(u, "buy") for u in range(5, 10) for _ in range(9)]
    df = spark.createDataFrame(rows, "user_id long, event_type string")
    shares = user_shares(df, "user_id", "event_type", ["buy", "click"])
    seg = {r["user_id"]: r["segment"] for r in kmeans_segments(shares, "shares", k=2).collect()}
    assert len({seg[u] for u in range(5)}) == 1 and len({seg[u] for u in range(5, 10)}) == 1
    assert seg[0] != seg[9]


def test_merge_topics_groups_near_centroids(spark):
    cents = spark.createDataFrame([(0, [0.0, 0.0], 10), (1, [0.1, 0.0], 5), (2, [5.0, 5.0], 7), (3, [5.1, 5.0], 3)],
                                  "cluster int, centroid array<double>, n_points long")
    m = {r["cluster"]: r["merged_topic"] for r in merge_topics(cents, "cluster", 2).collect()}
    assert m[0] == m[1] and m[2] == m[3] and m[0] != m[2]


def test_report_and_spec_sinks(spark):
    specs = spark.createDataFrame(
        [(1, "tracker", "Tracking pain", "Users cannot track", ["defi"], [], [("trader",)],
          (62.4, 9.0, 2.0), ("frustration", 0.9, "rising"), ["quote a", "quote b", "quote c", "quote d"])],
        "rank long, skill_name string, need_name string, need_description string, source_topics array<string>, "
        "source_topic_labels array<string>, personas array<struct<segment_name:string>>, "
        "opportunity struct<final_score:double,importance:double,satisfaction:double>, "
        "emotion_profile struct<dominant_emotion:string,avg_intensity:double,trend:string>, evidence array<string>")
    lines = [r["line"] for r in sinks.report_lines(specs, 24, 2, "t1").orderBy("line_no").collect()]
    assert lines[0] == "# Skill 需求报告 t1" and "- 帖子总量：24 条" in lines
    assert "| 1 | `tracker` | Tracking pain | 62.4 | 📈 | defi | — |" in lines
    assert "> quote c" in lines and "> quote d" not in lines
    assert "**机会分**：62.4 (importance=9.0, satisfaction=2.0)" in lines
    out = tempfile.mkdtemp(prefix="needlens-sink-")
    p = sinks.write_specs(specs, out, "t1")
    back = spark.read.json(p)
    assert back.count() == 1 and back.first()["skill_name"] == "tracker"
    rp = sinks.write_report(sinks.report_lines(specs, 24, 2, "t1"), out, "t1")
    text = "\n".join(r[0] for r in spark.read.text(rp).collect())
    assert text.startswith("# Skill 需求报告 t1") and text.rstrip().endswith("(Ulwick)")
    assert os.path.basename(rp) == "needs_report_t1.md"
