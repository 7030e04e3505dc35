"""Centroid clustering against plain Lloyd rounds, awkward rows, and what the heaps must save."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifeboat.llm import centroid_cluster as cc
from lifeboat.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v double, cluster int"


def lloyd(rows, s):
    """(cluster, distance) of every row that takes part, centroids: plain rounds over all distances."""
    kept = [(i, [int(np.floor(s.scale * float(np.float32(x)))) for x in e]) for i, e in rows
            if e is not None and len(e) == s.dimensions and all(x is not None and np.isfinite(x) for x in e)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{s.seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[0] or 0, r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:s.clusters]]
    for number in range(s.rounds + 1):
        own = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            own.append((d.index(min(d)), min(d)))
        if number < s.rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), (a, _) in zip(kept, own) if a == c]
                if mine:
                    centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i is None, i or 0), c, d) for (i, _), (c, d) in zip(kept, own)), centroids


def check(spark, rows, s, layout=3):
    df = spark.createDataFrame([(i, e, 0, "x", 1.5, 7) for i, e in rows], SCHEMA).repartition(layout)
    out, clusters, scans = cc.cluster(df, s)
    got = sorted(((r["id"] is None, r["id"] or 0), r["cluster"], r["distance"]) for r in out.collect())
    want, centroids = lloyd(rows, s)
    assert got == want
    assert [c["centroid"] for c in clusters] == centroids
    for c in clusters:
        assert (c["size"], c["inertia"]) == (sum(x[1] == c["cluster"] for x in got), sum(x[2] for x in got if x[1] == c["cluster"]))
    return scans


def test_rounds_are_lloyd_s(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 2, (9, 6))
    rows = [(i, [float(x) for x in centers[i % 9] + rng.normal(0, 0.3, 6)]) for i in range(900)]
    scans = check(spark, rows, cc.Settings(clusters=9, rounds=5, dimensions=6, block_rows=64))
    assert scans[0] == 900 and scans[-1] < 450        # settled vectors are not looked at again
    assert check(spark, rows, cc.Settings(clusters=9, rounds=5, dimensions=6, block_rows=5), layout=7)[0] == 900


def test_edges(spark):
    s = cc.Settings(clusters=4, rounds=3, dimensions=3, block_rows=4)
    rows = [(1, [0.0, 0.0, 0.0]), (2, None), (3, []), (4, [1.0, 2.0]), (5, [1.0, 2.0, 3.0, 4.0]), (6, [1.0, None, 3.0]),
            (7, [float("nan"), 0.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, [-0.01, 0.01, -1.0]), (9, [-0.01, 0.01, -1.0]),
            (9, [0.5, 0.5, 0.5]), (None, [0.25, 0.25, 0.25]), (None, [0.75, 0.25, 0.25]), (10, [0.0, 0.0, 0.0]),
            (11, [1e6, -1e6, 5.0]), (12, [0.125, 0.0, 0.0]), (13, [0.0, 0.125, 0.0])] + [(100 + i, [0.5, -0.5, 0.0]) for i in range(40)]
    check(spark, rows, s)
    check(spark, rows[:1], s)                           # fewer vectors than clusters
    check(spark, rows[:2] + rows[8:10], s)
    check(spark, [(i, [0.0, 0.0, 0.0]) for i in range(9)], s)       # all the same: one cluster has all
    check(spark, rows, cc.Settings(clusters=1, rounds=2, dimensions=3))


def test_empty_and_too_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    out, clusters, scans = cc.cluster(none)
    assert out.columns == ["id", "cluster", "distance"] and out.count() == 0 and clusters == [] and scans == []
    big = spark.createDataFrame([(1, [1e9, 0.0], 0, "x", 0.0, 1)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        cc.cluster(big, cc.Settings(dimensions=2))


def test_large_components_are_exact():
    rng = np.random.default_rng(2)
    v = rng.integers(-(1 << 27), 1 << 27, (50, 64)).astype(np.int32)
    c = rng.integers(-(1 << 27), 1 << 27, (5, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert cc.distances(v, c).tolist() == want


def test_bounds_hold_over_many_small_drifts():
    """No vector whose assignment changes stays in its heap, however the centroids wander."""
    rng = np.random.default_rng(5)
    v = rng.integers(-60, 60, (400, 4)).astype(np.int32)
    centroids = rng.integers(-60, 60, (6, 4))
    block, drift = cc.Block(v, 6), np.zeros(6)
    scanned = []
    for _ in range(40):
        block_change, n = block.advance(centroids, drift)
        scanned.append(n)
        assert (block.cluster == cc.distances(v, centroids).argmin(1)).all()
        moved = centroids + rng.integers(-1, 2, centroids.shape)
        step = np.array([cc._length(a - b) for a, b in zip(moved, centroids)])
        drift = drift + step + np.array([np.delete(step, c).max() for c in range(6)])
        centroids = moved
    assert sorted(i for h in block.heaps for _, i in h) == list(range(400))
    assert np.mean(scanned[1:]) < 300


def test_documents_scale(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    out, _, _ = cc.cluster(df.withColumn("id", F.lit("clash")))
    assert sorted(((False, r["id"]), r["cluster"], r["distance"]) for r in out.collect()) == lloyd(rows, cc.Settings())[0]
