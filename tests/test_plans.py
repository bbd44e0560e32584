"""Physical-plan properties the design relies on."""

import contextlib
import io

import pytest

from needlens.plans.queries import QUERIES

from conftest import SF_SMALL

# queries whose plans are built from table scans alone (the clustering stages
# run jobs while they are built and are checked elsewhere)
TABLE_QUERIES = [n for n in QUERIES if n not in (
    "topic_pipeline", "need_clusters", "pipeline_specs", "density_clusters", "user_segments", "merged_topics",
    "topic_stage", "need_stage", "full_run", "run_metrics", "varied_density_clusters")]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_plan_hygiene(spark, name):
    """No cartesian products, and no Python in the plan (all JVM expressions)."""
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_top_k_is_cut_before_the_shuffle(spark):
    p = plan(QUERIES["top_per_topic"](spark, SF_SMALL))
    partial = p.index("WindowGroupLimit")
    assert "Partial" in p and partial >= 0


def test_time_filters_reach_the_scan(spark):
    p = plan(QUERIES["missing_keys"](spark, SF_SMALL))
    assert "GreaterThan(ts," in p and "LessThanOrEqual(ts," in p


def test_vocabulary_is_the_only_broadcast(spark):
    import re
    from needlens.operators.ctfidf import ctfidf_keywords
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    # the ranking of present terms; the dense grid joins more tables of bounded size
    p = plan(ctfidf_keywords(docs, "source", "text", include_absent=False))
    nodes = re.findall(r"^\(\d+\) (\w+)", p, flags=re.M)  # one header per physical node
    assert nodes.count("BroadcastExchange") == 1 and "TakeOrderedAndProject" in nodes


def test_scans_read_only_needed_columns(spark):
    p = plan(QUERIES["creator_join"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
