"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is evaluated completely through the ``noop`` sink (no collect to
the driver) and timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from needlens.plans.queries import QUERIES  # noqa: E402
from needlens.session import build_session  # noqa: E402

HEADLINE = [
    "clean_posts", "latin_ratio", "dedup_first", "ctfidf_keywords_by_source", "sentiment_rescale",
    "network_norm", "topic_norm", "personas", "emotion_profile", "daily_series", "trend_series",
    "trend_velocity", "opportunity", "top_clusters", "source_sets", "creator_join", "persona_matrix",
    "topics_over_time", "top_per_topic", "stage_metrics", "fresh_results", "missing_keys", "run_latest",
    "run_list", "cluster_centroids", "representatives", "radius_pairs", "grid_pairs", "density_clusters",
    "extract_records", "render_prompts", "refined_specs", "report_rows", "feed_ingest", "user_segments",
    "merged_topics",
    "nearest_neighbours", "radius_pairs_hashed", "reachability_tree", "varied_density_clusters", "single_topic_feed",
    "feed_states", "flat_feed", "stored_or_fetched", "purged_results", "topic_stage", "need_stage", "full_run", "run_metrics",
    "topic_pipeline", "need_clusters", "pipeline_specs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="needlens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in only or HEADLINE:
        fn = QUERIES.get(name)
        if fn is None:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"# {name}: {times.get(name, 'failed')}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
