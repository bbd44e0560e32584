"""Centroid clustering by Shallot search (operator 11).

Vectors become whole numbers (``floor(scale * x)``) and are packed into blocks.
Every vector keeps its centroid, its second-nearest centroid, an upper bound of
the distance to the first and a lower bound of the distance to all others.  A
round (Borgelt's Shallot variant of exact k-means):

1. The bounds are widened by how far the centroids moved.  A vector whose upper
   bound stays below its lower bound, or below half the gap between its centroid
   and the next one, keeps its centroid without a distance.
2. Otherwise the distances to the two remembered centroids are computed and the
   search starts from the closer one, ``s``.
3. The other centroids are walked by rising distance from ``s``.  A centroid can
   matter only if its distance from ``s`` is at most d(x, s) + the second-best
   distance so far; the ball shrinks as the second-best distance falls.
4. The survivors are compared by squared distances in whole numbers, ties to the
   smaller number.

Bounds carry a slack far above rounding errors, so every round equals the plain
assignment.  A round reads the block table of the round before, writes its own,
and drops the older one; sums of each cluster are added up in every task and
only ``k * (dim + 1)`` numbers of a task are shuffled.  Broadcast: the ``k``
centroids, whose number is a parameter.

Defined results: vectors that are null, hold null or non-finite components or
have another length take no part.  A null id takes part but starts no centroid
unless there are fewer other rows than centroids; rows that repeat an id start
in the order of their vectors.  With fewer vectors than centroids, each vector
starts one.  An empty centroid stays where it is.  Components so large that a
squared distance would not fit in a long raise an error.  No vectors: no rows.
Extra columns are passed over.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from needlens.llm.shared import drop_stage, staged

K = 16
ROUNDS = 3
DIM = 64
SCALE = 64
SEED = 1
BLOCK = 4096  # vectors of a block
SLACK = 1e-9

_STATE = ("ids array<bigint>, vectors binary, first binary, second binary, upper binary, lower binary, "
          "distance array<bigint>, totals array<bigint>")


def largest_component(dim: int) -> int:
    """Components up to this keep a squared distance below 2 ** 62."""
    return int((2 ** 62 / max(dim, 1)) ** 0.5) // 2


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as whole numbers; ``values`` is a matrix."""
    x = np.floor(scale * values.astype(np.float64))
    if len(x) and np.abs(x).max() > largest_component(values.shape[1]):
        raise ValueError("a component is too large: squared distances would not fit in a long")
    return x.astype(np.int64)


def usable(vector: Column, dim: int) -> Column:
    """Vectors of ``dim`` components, none null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dim) & F.coalesce(fine, F.lit(False))


def narrow(x: np.ndarray) -> np.dtype:
    """The smallest whole-number type that holds ``x``."""
    top = int(np.abs(x).max(initial=0))
    return np.dtype(next(t for t, most in (("<i1", 127), ("<i2", 32767), ("<i4", 2 ** 31 - 1), ("<i8", 2 ** 63 - 1))
                         if top <= most))


class Search:
    """One round's centroids, the gaps between them and how far they moved."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray):
        self.c, k = centroids, len(centroids)
        gap = np.sqrt(np.stack([((centroids - c) ** 2).sum(1) for c in centroids]).astype(np.float64))
        np.fill_diagonal(gap, -1.0)
        self.order = np.argsort(gap, axis=1, kind="stable")[:, 1:]  # the others by rising distance
        self.gap = gap * (1 - SLACK)
        self.half = self.gap[np.arange(k), self.order[:, 0]] / 2 if k > 1 else np.full(k, np.inf)
        self.moved = moved * (1 + SLACK)
        most = np.argsort(-self.moved, kind="stable")
        self.most = np.full(k, self.moved[most[0]])  # the largest move of any other centroid
        if k > 1:
            self.most[most[0]] = self.moved[most[1]]

    def distance(self, x: np.ndarray, j: np.ndarray) -> np.ndarray:
        d = x - self.c[j]
        return np.einsum("ij,ij->i", d, d)

    def assign(self, x, first, second, upper, lower):
        """New (first, second, upper, lower) of the vectors ``x`` (whole numbers)."""
        first, second = first.copy(), second.copy()
        upper, lower = upper + self.moved[first], lower - self.most[first]
        if len(self.c) == 1:
            return first, second, upper, lower
        rows = np.flatnonzero(upper >= np.maximum(lower, self.half[first]))
        best = self.distance(x[rows], first[rows])
        upper[rows] = np.sqrt(best) * (1 + SLACK)
        still = upper[rows] >= np.maximum(lower[rows], self.half[first[rows]])
        rows, best = rows[still], best[still]
        if not len(rows):
            return first, second, upper, lower
        v, a, b = x[rows], first[rows], second[rows]
        after = self.distance(v, b)
        swap = (after < best) | ((after == best) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        best, after = np.where(swap, after, best), np.where(swap, best, after)
        start, reach = a.copy(), np.sqrt(best) * (1 + SLACK)
        live = np.arange(len(rows))
        for p in range(self.order.shape[1]):
            j = self.order[start[live], p]
            inside = self.gap[start[live], j] <= reach[live] + np.sqrt(after[live]) * (1 + SLACK)
            live, j = live[inside], j[inside]
            if not len(live):
                break
            new = (j != a[live]) & (j != b[live])
            i, j = live[new], j[new]
            d = self.distance(v[i], j)
            wins = (d < best[i]) | ((d == best[i]) & (j < a[i]))
            w, o = i[wins], ~wins & (d < after[i])
            after[w], b[w] = best[w], a[w]
            best[w], a[w] = d[wins], j[wins]
            after[i[o]], b[i[o]] = d[o], j[o]
        first[rows], second[rows] = a, b
        upper[rows], lower[rows] = np.sqrt(best) * (1 + SLACK), np.sqrt(after) * (1 - SLACK)
        return first, second, upper, lower


def _row(ids, *values):
    kinds = (pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(),
             pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = ("ids", "vectors", "first", "second", "upper", "lower", "distance", "totals")
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), *(pa.array([v], t) for v, t in zip(values, kinds))], names)


def _pack(dim, scale, size):
    """Rows (id, vector) packed into blocks without a state yet."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                x = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = whole(x, scale)
                kind = narrow(x)
                yield _row(part.column("id").to_pylist(), kind.str.encode() + x.astype(kind).tobytes(),
                           None, None, None, None, None, None)
    return run


def _round(shared, dim, last):
    """One assignment of all blocks; the last row of a task holds its sums."""
    def run(batches):
        centroids, moved = shared.value
        k, search = len(centroids), Search(centroids, moved)
        totals = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                x = np.frombuffer(row["vectors"][3:], row["vectors"][:3].decode()).reshape(-1, dim).astype(np.int64)
                if row["first"] is None:
                    state = (np.zeros(len(x), np.int32), np.full(len(x), min(1, k - 1), np.int32),
                             np.full(len(x), np.inf), np.zeros(len(x)))
                else:
                    state = (np.frombuffer(row["first"], np.int32), np.frombuffer(row["second"], np.int32),
                             np.frombuffer(row["upper"]), np.frombuffer(row["lower"]))
                state = search.assign(x, *state)
                first = state[0]
                if last:
                    d = search.distance(x, first)
                    yield _row(row["ids"], None, first.tobytes(), None, None, None, d, None)
                    continue
                by = np.argsort(first, kind="stable")
                used, at = np.unique(first[by], return_index=True)
                totals[used, :dim] += np.add.reduceat(x[by], at, axis=0)
                totals[used, dim] += np.diff(np.append(at, len(x)))
                yield _row(row["ids"], row["vectors"], *(s.tobytes() for s in state), None, None)
        if not last:
            yield _row(None, *[None] * 6, totals.ravel())
    return run


def _rows(batches):
    """The last round's blocks as rows."""
    for batch in batches:
        for n in range(batch.num_rows):
            ids, first, d = (batch.column(c)[n] for c in ("ids", "first", "distance"))
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(np.frombuffer(first.as_py(), np.int32)), d.values], ["id", "cluster", "distance"])


def start(kept: DataFrame, k: int, seed: int, scale: int, dim: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``: k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "id", "vector").limit(k).collect()
    return whole(np.array([r["vector"] for r in rows], np.float64).reshape(-1, dim), scale)


def new_centroids(blocks: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of every cluster that has vectors."""
    cells = (blocks.where("totals IS NOT NULL").select(F.posexplode("totals").alias("cell", "v"))
                   .groupBy("cell").agg(F.sum("v").alias("v")).collect())  # k * (dim + 1) numbers
    totals = np.zeros(old.shape[0] * (old.shape[1] + 1), np.int64)
    for r in cells:
        totals[r["cell"]] = r["v"]
    totals = totals.reshape(len(old), -1)
    sums, n = totals[:, :-1], totals[:, -1:]
    return np.where(n > 0, sums // np.maximum(n, 1), old)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` (squared) of every vector after ``rounds`` updates
    and a last assignment, and the final centroids (whole numbers)."""
    spark = vectors.sparkSession
    kept = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
                   .where(usable(F.col("vector"), dim)))
    centroids = start(kept, k, seed, scale, dim)
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long"), centroids
    blocks = staged(kept.mapInArrow(_pack(dim, scale, BLOCK), _STATE), "centroids-blocks")
    moved = np.zeros(len(centroids))
    for r in range(rounds + 1):
        last = r == rounds
        shared = spark.sparkContext.broadcast((centroids, moved))  # k centroids
        done = staged(blocks.where("ids IS NOT NULL").mapInArrow(_round(shared, dim, last), _STATE), f"centroids-{r}")
        drop_stage(blocks)
        blocks = done
        if not last:
            new = new_centroids(blocks, centroids)
            moved = np.sqrt(((new - centroids) ** 2).sum(1).astype(np.float64))
            centroids = new
    rows = blocks.select("ids", "first", "distance").mapInArrow(_rows, "id bigint, cluster int, distance bigint")
    return rows, centroids


def op11_centroid_clusters(spark, sf_dir):
    """Contract query: every usable vector with its cluster, distance and inertia."""
    rows, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    sums = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    told = [(j, sums.get(j, 0), sum(sums.values()),
             hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (rows.join(F.broadcast(told), "cluster")  # one row a centroid
                .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256"))


def op11_sql(k: int = K, rounds: int = ROUNDS) -> str:
    """The same in DuckDB: plain assignments, one block of CTEs for each round."""
    near = """a{r} AS (
  SELECT rid, vec_id, e, arg_min(j, [d, j]) AS cluster, min(d) AS distance FROM (
    SELECT v.*, c.j, CAST(list_sum(list_transform(list_zip(v.e, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{r} c) GROUP BY rid, vec_id, e)"""
    step = """m{r} AS (
  SELECT cluster AS j, p, sum(e[p]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS p) GROUP BY cluster, p
), c{s} AS (
  SELECT c.j, coalesce(n.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS c FROM m{r} GROUP BY j) n USING (j))"""
    body = []
    for r in range(rounds + 1):
        body.append(near.format(r=r))
        if r < rounds:
            body.append(step.format(r=r, s=r + 1))
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS j, e AS c
  FROM (SELECT e, sha256('{SEED}:' || vec_id) AS h FROM v ORDER BY h LIMIT {k})
), {", ".join(body)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.j"""
