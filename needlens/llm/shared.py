"""Small helpers of the subpackage: stage tables, byte access to shared files,
and the session's parallelism."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needlens.session import stage_dir
from needlens.sources.tables import load  # noqa: F401  (re-exported for the query modules)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the session's JVM ends."""
    path = f"{stage_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared folder and read it
    back: cuts lineage, survives lost executors, and is computed once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a table made by ``staged`` that nothing reads any more."""
    path = getattr(df, "_stage_path", None)
    if path:
        spark = df.sparkSession
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def shuffle_partitions(spark: SparkSession) -> int:
    n = str(spark.conf.get("spark.sql.shuffle.partitions", ""))
    return int(n) if n.isdigit() else spark.sparkContext.defaultParallelism


def open_fs(uri: str):
    """``(filesystem, path)`` of a URI for byte access inside tasks (local or
    mounted folders, HDFS, S3, GCS), through pyarrow's public file systems."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def batch_slices(batches, text_col: str, size: int):
    """Parts of Arrow batches with about ``size`` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if b.num_rows:
            lengths = pc.binary_length(b.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(lengths) // size
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for i, j in zip(edges, edges[1:]):
                yield b.slice(i, j - i)


def text_slices(batches, text_col: str, others: tuple[str, ...], size: int):
    """Per part of about ``size`` bytes of text: two of the columns ``others`` (None
    for a second that is not named), the bytes of the texts laid end to end, and
    where each text ends.  Null text is empty."""
    import numpy as np
    import pyarrow as pa

    for b in batch_slices(batches, text_col, size):
        text = b.column(text_col)
        text = text.fill_null("") if text.null_count else text
        _, places, data = text.buffers()
        wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
        at = np.frombuffer(places, np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        yield (b.column(others[0]), b.column(others[1]) if len(others) > 1 else None,
               raw[at[0]:at[-1]], at[1:] - at[0])


def quoted(name: str) -> str:
    """A column name as one part of a reference."""
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, *more) -> DataFrame:
    """``docs`` with all its columns in the struct ``row``, beside the columns ``more``:
    no column name of the caller can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), *more)


def worker_state(kind: str) -> dict:
    """A dict that lives as long as the Python worker process, for the model and the
    caches of one operator.  What another operator left there is dropped, so that the
    caches of several stages never add up."""
    import pyspark

    held = pyspark.__dict__.setdefault("_needlens_worker_state", {})
    for other in [k for k in held if k != kind]:
        del held[other]
    return held.setdefault(kind, {})
