"""Approximate radius join by p-stable hashing, with a recall model.

A table hashes a vector by ``k`` random projections cut into cells of width ``w``
(Datar, Immorlica, Indyk, Mirrokni 2004).  Two points at distance ``r`` agree in one
projection with probability ``collision(r, w)``, so a pair within ``eps`` shares a
bucket of at least one of ``L`` tables with probability at least
``1 - (1 - collision(eps, w) ** k) ** L``; ``tables_for`` takes the least ``L`` that
reaches the wanted recall.  What is returned is exact: every pair is verified by its
distance, in the first table only in which it meets.

Equal vectors are one point.  A bucket of more than ``BLOCK`` points is split into
pairs of blocks, so no group is unbounded; buckets of one point are dropped before the
vectors are moved.  A block's pairs are screened by matrix products (``close_pairs``), some
rows at a time.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from needlens.operators.metrictree import close_pairs, distinct_points, matrix
from needlens.operators.scratch import Scratch

BLOCK = 32768  # points of a block of one bucket
WIDTH = 2.0  # width of a cell in units of eps
HASHES = 4  # projections a table
RECALL = 0.95

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need numpy and pyarrow only


def collision(r: float, w: float) -> float:
    """Probability that one projection puts two points at distance ``r`` in one cell."""
    if r <= 0:
        return 1.0
    t = w / r
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def expected_recall(r: float, w: float, hashes: int, tables: int) -> float:
    return 1 - (1 - collision(r, w) ** hashes) ** tables


def tables_for(eps: float, w: float, hashes: int, recall: float) -> int:
    p = collision(eps, w) ** hashes
    return 1 if p >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _buckets(dim: int, w: float, hashes: int, tables: int, seed: int):
    def run(batches):
        rng = np.random.default_rng(seed)
        axes, shift = rng.normal(size=(dim, tables * hashes)), rng.uniform(0, w, tables * hashes)
        mix = rng.integers(1, 1 << 62, (tables, hashes), dtype=np.int64) * 2 + 1
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("v"))
                cells = np.floor((x @ axes + shift) / w).astype(np.int64)
                keys = (cells.reshape(-1, tables, hashes) * mix).sum(2)
                keys ^= keys >> 29
                packed = pa.array([k.astype("<i8").tobytes() for k in keys], pa.binary())
                vecs = pa.array([v.astype("<f8").tobytes() for v in x], pa.binary())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("id"), vecs, packed, lists], ["id", "vec", "all", "keys"])
    return run


def _bucket_pairs(eps: float, tables: int, dim: int):
    """Pairs within ``eps`` of every (table, key, i, j), which come one after the other."""
    names = ("t", "key", "i", "j")

    def packed(parts, column, kind, width):
        raw = b"".join(v for p in parts for v in p.column(column).to_pylist())
        return np.frombuffer(raw, kind).reshape(-1, width)

    def pairs(parts, t):
        ids = np.concatenate([p.column("id").to_numpy() for p in parts])
        if len(ids) < 2:
            return
        side = np.concatenate([p.column("side").to_numpy() for p in parts])
        x, keys = packed(parts, "vec", "<f8", dim), packed(parts, "all", "<i8", tables)[:, :t]
        whole = side[0] == 2  # a block with itself
        a, b = (np.arange(len(ids)),) * 2 if whole else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        for i, j, d in close_pairs(x[a], x[b], eps, upper=bool(whole)):
            i, j = a[i], b[j]
            if t:
                first = ~(keys[i] == keys[j]).any(1)
                i, j, d = i[first], j[first], d[first]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(d)],
                                                 ["id_a", "id_b", "dist"])

    def run(batches):
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
            cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                now = tuple(int(c) for c in key[start])
                if now != at:
                    if held:
                        yield from pairs(held, at[0])
                    held, at = [], now
                held.append(batch.slice(start, end - start))
        if held:
            yield from pairs(held, at[0])
    return run


def radius_pairs_lsh(df: DataFrame, id_col: str, vec_col: str, eps: float, recall: float = RECALL, hashes: int = HASHES,
                     width: float | None = None, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """``id_a, id_b, dist`` with ``id_a < id_b`` and distance <= eps: each such pair with
    probability at least ``recall`` over the seeds."""
    spark = df.sparkSession
    w = width or WIDTH * max(eps, 1e-9)
    tables = tables_for(eps, w, hashes, recall)
    scratch = Scratch(spark, "lsh")
    points, members = distinct_points(df, id_col, vec_col, scratch)
    first = points.select(F.size("v").alias("d")).first()
    dim = first["d"] if first else 0
    hashed = scratch.keep(points.select("id", "v").mapInArrow(
        _buckets(dim, w, hashes, tables, seed), "id long, vec binary, all binary, keys array<long>"), "hashed")
    cells = hashed.select("id", F.posexplode("keys").alias("t", "key"))
    size = cells.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    size = scratch.keep(size.select("t", "key", F.ceil(F.col("size") / block).cast("int").alias("parts")), "sizes")
    met = cells.join(size, ["t", "key"]).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"),
        F.when(o == F.col("mine"), 2).when(o > F.col("mine"), 0).otherwise(1).alias("side")))
    met = met.select("id", "t", "key", F.explode(other).alias("p")).select("id", "t", "key", "p.i", "p.j", "p.side")
    rows = met.join(hashed.select("id", "vec", "all"), "id").repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    found = scratch.keep(rows.mapInArrow(_bucket_pairs(eps, tables, dim), "id_a long, id_b long, dist double"), "found")
    several = points.where("n > 1").select(F.col("id").alias("rep"))
    if several.isEmpty():
        return found
    a, b = members.toDF("m_a", "id_a"), members.toDF("m_b", "id_b")
    far = found.join(a, "id_a").join(b, "id_b").select(
        F.least("m_a", "m_b").alias("id_a"), F.greatest("m_a", "m_b").alias("id_b"), "dist")
    twins = members.join(several, "rep")
    near = (twins.toDF("rep", "id_a").join(twins.toDF("rep", "id_b"), "rep").where("id_a < id_b")
                 .select("id_a", "id_b", F.lit(0.0).alias("dist")))
    return far.unionByName(near)
