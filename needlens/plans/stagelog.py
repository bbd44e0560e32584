"""Restartable runs (S8, R1): a manifest of finished stages.

A stage is a named table of a run.  It is written to a folder of its own; then the
manifest, a small JSON file, is replaced by one that names it, with its row count (write
to a temporary name, delete, rename).  A run that starts again with the same inputs and
code version reads finished stages and goes on after them; other inputs start anew.  A
stage that nothing reads any more is deleted, its entry stays: a run holds the table it
reads and the one it writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

VERSION = 1  # of the stages' code: raise it when a stage's result changes


class StageLog:
    def __init__(self, spark: SparkSession, work_dir: str, run_id: str, inputs: str = ""):
        self.spark, self.base = spark, f"{work_dir.rstrip('/')}/{run_id}"
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._at(""))
        self.manifest = self._load()
        key = {"inputs": inputs, "version": VERSION}
        if {k: self.manifest.get(k) for k in key} != key:
            for name in list(self.manifest.get("stages", {})):
                self.consumed(name)
            self.manifest = {**key, "stages": {}}

    def _at(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def _load(self) -> dict:
        for name in ("manifest.json", "manifest.next"):  # the second if a run died between delete and rename
            if self._fs.exists(self._at(name)):
                stream = self._fs.open(self._at(name))
                try:
                    return json.loads(bytes(stream.readAllBytes()).decode())
                except ValueError:
                    continue
                finally:
                    stream.close()
        return {}

    def _save(self) -> None:
        out = self._fs.create(self._at("manifest.next"), True)
        out.write(json.dumps(self.manifest, sort_keys=True).encode())
        out.close()
        self._fs.delete(self._at("manifest.json"), False)
        self._fs.rename(self._at("manifest.next"), self._at("manifest.json"))

    def rows(self, name: str) -> int | None:
        """Row count of a finished stage."""
        entry = self.manifest["stages"].get(name)
        return entry["rows"] if entry else None

    def stage(self, name: str, build) -> DataFrame:
        """The stage's table: read if finished, else built by ``build()`` and written."""
        entry = self.manifest["stages"].get(name)
        if entry and not entry["gone"]:
            return self.spark.read.parquet(f"{self.base}/{entry['folder']}")
        folder = f"{name}-{uuid.uuid4().hex}"
        build().write.parquet(f"{self.base}/{folder}")
        out = self.spark.read.parquet(f"{self.base}/{folder}")
        self.manifest["stages"][name] = {"folder": folder, "rows": out.count(), "gone": False}
        self._save()
        return out

    def finished(self, name: str) -> bool:
        return name in self.manifest["stages"]

    def consumed(self, *names: str) -> None:
        """Delete tables that no stage still to come reads."""
        for name in names:
            entry = self.manifest["stages"].get(name)
            if entry and not entry["gone"]:
                entry["gone"] = True
                self._save()
                self._fs.delete(self._at(entry["folder"]), True)

    def tables(self) -> list[str]:
        """Stages whose tables are there."""
        return sorted(n for n, e in self.manifest["stages"].items() if not e["gone"])


def run_restartable(posts: DataFrame, states: DataFrame | None = None, series: DataFrame | None = None, *, work_dir: str,
                    run_id: str, inputs: str = "", out_dir: str | None = None, top_n: int | None = None,
                    dedup_key: str = "post_id", embed_fn=None, answer_fn=None, answer_log: str | None = None,
                    topic_labels=None, need_labels=None) -> DataFrame:
    """The full run (C15) as restartable stages: the spec rows, also written with the
    report below ``out_dir``.  ``inputs`` names what is read (paths, dates)."""
    from needlens.plans.collect import collect
    from needlens.plans.needs import aggregate_needs, extract_needs, global_trend, kept_records
    from needlens.plans.specs import TOP_N_SPECS, generate_specs
    from needlens.plans.topics import cluster_topics
    from needlens.sources import sinks

    log = StageLog(posts.sparkSession, work_dir, run_id, inputs)
    asked = {"answer_fn": answer_fn, "answer_log": answer_log}

    def topics():
        kept = log.stage("posts", lambda: collect(posts, dedup_key))
        return cluster_topics(kept, embed_fn=embed_fn, materialized=True, labels=topic_labels, **asked)

    def records():
        return kept_records(extract_needs(log.stage("topics", topics), **asked))

    def clusters():
        rows = log.stage("records", records)
        log.consumed("posts", "topics")
        return aggregate_needs(rows, global_trend(states, series), embed_fn=embed_fn, labels=need_labels, **asked)

    def specs():
        rows = log.stage("clusters", clusters)
        log.consumed("records")
        return generate_specs(rows, top_n or TOP_N_SPECS, **asked)[0]

    out = log.stage("specs", specs)
    log.consumed("posts", "topics", "records", "clusters")
    if out_dir and log.rows("specs"):
        suffix = sinks.run_suffix(run_id)
        sinks.write_specs(out, out_dir, suffix)
        sinks.write_report(sinks.report_lines(out, log.rows("topics"), log.rows("clusters"), suffix), out_dir, suffix)
    return out
