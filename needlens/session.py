"""Session construction and cluster-wide settings.

The library never creates a session on its own when one exists: library code
takes ``spark`` from the caller.  ``build_session`` is for tests, the bench and
command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry.  UTC keeps timestamps engine-neutral;
# AQE re-plans joins and coalesces shuffles at run time; skew join splits hot
# partitions of sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # broadcast joins are chosen explicitly behind size checks (needlens.operators.join)
    # or by AQE on measured sizes; the static threshold stays at Spark's default.
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "needlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used as
    is; on a cluster without it this raises.  Only for a ``local[...]`` master
    (tests) a private folder is created.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="needlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def stage_dir(spark: SparkSession, name: str) -> str:
    """A folder for a stage table, below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "stages", name)
