"""The driver module must import and list its queries without a Spark session,
also when pyspark comes from pyspark.zip (no jars beside it)."""

import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = ("import __spark_entry__ as e, pyspark; q, s = e.queries(), e.oracle_sql(); "
         "assert len(q) >= 39 and len(s) >= 34, (len(q), len(s)); "
         "from pyspark.sql import SparkSession; assert SparkSession.getActiveSession() is None; "
         "print(pyspark.__file__)")


def _probe(path):
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(path)}
    return subprocess.run([sys.executable, "-c", PROBE], cwd=REPO, env=env,
                          capture_output=True, text=True, timeout=120)


def test_entry_without_session():
    r = _probe([REPO])
    assert r.returncode == 0, r.stderr[-2000:]


def test_entry_with_zipped_pyspark():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, z) for z in os.listdir(lib) if z.endswith(".zip")]
    r = _probe([*zips, REPO])
    assert r.returncode == 0, r.stderr[-2000:]
    assert "pyspark.zip" in r.stdout
