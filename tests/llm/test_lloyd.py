import hashlib
import math
import random

import numpy as np
import pytest

from orderloom.llm import lloyd


def brute(rows, k, rounds, dims, seed=2):
    """(id, cluster, distance), and the centroids, in Python integers."""
    kept = [(i, [max(-lloyd.LIMIT, min(lloyd.LIMIT, math.floor(256 * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        member = [nearest(v)[1] for _, v in kept]
        centroids = [[sum(col) // len(col) for col in zip(*own, strict=True)] if own else centroids[j]
                     for j in range(len(centroids)) for own in [[v for (_, v), m in zip(kept, member, strict=True) if m == j]]]
    return sorted([(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], key=str), centroids


def vectors(rng, n, dims):
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 3) for _ in range(dims)]) for i in range(n)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (n + 1, None), (n + 2, []), (n + 3, [0.0] * (dims - 1)),
             (n + 4, [float("nan")] * dims), (n + 5, [float("-inf")] + [0.0] * (dims - 1)),
             (n + 6, [None] + [0.0] * (dims - 1)), (n + 7, [0.0] * dims), (n + 8, [0.0] * dims)]
    return rows


def check(spark, rows, k, rounds, dims, **options):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int").repartition(3)
    found, centroids = lloyd.clustered(df, k=k, rounds=rounds, dims=dims, **options)
    expected, means = brute(rows, k, rounds, dims)
    assert sorted([tuple(r) for r in found.collect()], key=str) == expected
    assert centroids.tolist() == means
    return found, centroids


@pytest.mark.parametrize("block_dims", [1, 3, 4, 9])
def test_against_python_integers(spark, block_dims, monkeypatch):
    monkeypatch.setattr(lloyd, "CHUNK", 17)
    check(spark, vectors(random.Random(1), 150, 9), 7, 3, 9, block_dims=block_dims)


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1e300, -1e300, 4e5, -3e5, 123456.789, 0.001, -5e-324]) for _ in range(4)]) for i in range(60)]
    check(spark, rows, 5, 2, 4, block_dims=3)


def test_fewer_vectors_than_clusters_ties_and_inertia(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])]
    found, centroids = check(spark, rows, 40, 2, 2)
    out = lloyd.with_inertia(found, centroids).collect()
    assert len(out) == 4 and all(r["inertia"] == 0 and r["cluster_inertia"] == 0 for r in out)
    for r in out:
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()


def test_inertia_over_clusters(spark):
    found, centroids = check(spark, vectors(random.Random(3), 80, 6), 4, 1, 6)
    rows = found.collect()
    for r in lloyd.with_inertia(found, centroids).collect():
        assert r["inertia"] == sum(x["distance"] for x in rows)
        assert r["cluster_inertia"] == sum(x["distance"] for x in rows if x["cluster"] == r["cluster"])


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    for part in (df, df.limit(0)):
        found, centroids = lloyd.clustered(part)
        assert lloyd.with_inertia(found, centroids).count() == 0


def test_partial_distances_add_up():
    rng = np.random.default_rng(0)
    x, c = rng.integers(-300, 300, (50, 64)), rng.integers(-300, 300, (8, 64))
    whole = ((x[:, None] - c[None]) ** 2).sum(2)
    parts = sum(lloyd._squared(x[:, a:a + 10].astype(np.int32), c[:, a:a + 10]) for a in range(0, 64, 10))
    assert (whole == parts).all()
