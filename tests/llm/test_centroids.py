import hashlib
import uuid

import numpy as np
import pytest

from needlens.llm import centroids as C


def _plain(x, start, rounds):
    """Lloyd's rounds with every distance, in whole numbers."""
    c = start.copy()
    for r in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        a = d.argmin(1)  # the first of equal distances
        if r < rounds:
            for j in range(len(c)):
                if (a == j).any():
                    c[j] = x[a == j].sum(0) // (a == j).sum()
    return a, d[np.arange(len(x)), a], c


def _want(rows, k=16, rounds=3):
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == 64 and all(e is not None and np.isfinite(e) for e in v)]
    if not kept:
        return []
    first = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", n)
                   for n, (i, _) in enumerate(kept))[:k]
    x = np.stack([v for _, v in kept])
    a, d, c = _plain(x, x[[n for *_, n in first]], rounds)
    sums = [int(d[a == j].sum()) for j in range(len(c))]
    return sorted((str(i), int(j), int(e), sums[j], int(d.sum()), hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest())
                  for (i, _), j, e in zip(kept, a, d))


def _got(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, distance int, cluster string")
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/embeddings.parquet")
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in C.op11_centroid_clusters(spark, path).collect())


def _vectors(rng, n, spread=0.3):
    x = rng.normal(size=(8, 64))[rng.integers(0, 8, n)] + rng.normal(size=(n, 64)) * spread
    return [[float(np.float32(e)) for e in v] for v in x]


def test_against_plain_rounds(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    rows = list(enumerate(_vectors(rng, 400)))
    rows += [(1000 + k, rows[k % 5][1]) for k in range(60)]  # copies, ties between starts
    rows += [(2000, None), (2001, [0.5] * 63), (2002, [float("nan")] * 64), (2003, [float("inf")] + [0.0] * 63),
             (2004, [None] + [0.0] * 63), (2005, []), (None, rows[3][1]), (2006, [0.0] * 64), (2007, [-1e4] * 64)]
    monkeypatch.setattr(C, "BLOCK", 37)
    assert _got(spark, rows, tmp_path) == _want(rows)


def test_few_and_no_vectors(spark, tmp_path):
    rng = np.random.default_rng(8)
    for rows in ([], [(1, None)], [(5, _vectors(rng, 1)[0])], list(enumerate(_vectors(rng, 9)))):
        assert _got(spark, [*rows, (99, [1.0])], tmp_path) == _want(rows)


def test_too_large_components_raise():
    with pytest.raises(ValueError):
        C.whole(np.full((1, 64), 1e9), 64)
    assert C.whole(np.full((1, 64), -1.001), 64)[0, 0] == -65


def test_search_equals_plain_and_saves_distances(monkeypatch):
    """Over many rounds: the same assignments, with a part of the distances."""
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(40, 8))[rng.integers(0, 40, 3000)] * 100 + rng.normal(size=(3000, 8)) * 4).astype(np.int64)
    c = x[rng.choice(3000, 40, replace=False)]
    c[7] = c[3]  # equal centroids: the smaller number wins
    calls = [0]
    plain = C.Search.distance

    def counted(self, v, j):
        calls[0] += len(v)
        return plain(self, v, j)
    monkeypatch.setattr(C.Search, "distance", counted)
    state = (np.zeros(3000, np.int32), np.ones(3000, np.int32), np.full(3000, np.inf), np.zeros(3000))
    moved = np.zeros(40)
    for _ in range(12):
        state = C.Search(c, moved).assign(x, *state)
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        assert (state[0] == d.argmin(1)).all()
        exact = np.sqrt(np.sort(d, 1).astype(float))
        assert (state[2] >= exact[:, 0]).all() and (state[3] <= exact[:, 1]).all()
        new = np.array([x[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else c[j]
                        for j in range(40)])
        moved = np.sqrt(((new - c) ** 2).sum(1).astype(float))
        c = new
    assert calls[0] < 0.35 * 12 * 3000 * 40
