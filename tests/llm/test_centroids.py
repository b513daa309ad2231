"""Clusters on small inputs; the query is compared with SQL in test_llm_queries."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starrung.llm.centroids import LARGEST, cluster_vectors

FORM = "vec_id long, embedding array<float>, label int"


def plain(rows, dimensions, clusters, rounds, scale=64, seed=1):
    """key, cluster, distance of each usable vector, and the centroids."""
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [max(-LARGEST, min(LARGEST, math.floor(scale * x))) for x in vector]))
    def name(key):
        return hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    centroids = [v for _, v in sorted((name(k), v) for k, v in kept)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            of = [v for (_, v), (_, j) in zip(kept, found) if i == j]
            if of:
                centroids[i] = [sum(x) // len(of) for x in zip(*of)]
    return [(k, i, d) for (k, _), (d, i) in zip(kept, assign())], centroids


def run(ws, spark, rows, **settings):
    docs = spark.createDataFrame([(k, v, 1) for k, v in rows], FORM).withColumns(
        {"row": F.lit("x"), "v": F.lit(2), "cluster": F.lit(-1), "distance": F.lit(None).cast("string")})
    return cluster_vectors(ws, docs, **settings)


@pytest.mark.parametrize("clusters,rounds", [(16, 3), (3, 1), (1, 2), (5, 0)])
def test_like_plain(spark, ws, clusters, rounds):
    draw = random.Random(clusters)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(200)]
    rows += [(1000 + i, [0.5, 0.5, -0.25, 0.0]) for i in range(100)]  # a third of all rows are the same
    rows += [(7, [1.0, 2.0, 3.0, 4.0]), (7, [1.0, 2.0, 3.0, 4.0]), (None, [0.0] * 4), (None, [9.0] * 4)]
    rows = [(k, np.float32(v).tolist()) for k, v in rows]
    odd = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [1.0, None, 1.0, 1.0]), (6, [1.0, math.nan, 1.0, 1.0]),
           (8, [math.inf, 0.0, 0.0, 0.0]), (9, [0.0, 0.0, -math.inf, 0.0])]
    found = run(ws, spark, rows + odd, dimensions=4, clusters=clusters, rounds=rounds)
    want, centroids = plain(rows + odd, 4, clusters, rounds)
    assert found.centroids == centroids
    got = found.rows.collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.cluster_inertia == sum(d for _, i, d in want if i == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
    assert found.digests() == [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]


def test_few_equal_and_huge_vectors(spark, ws):
    rows = [(i, [1.0, -1.0]) for i in range(5)]
    got = run(ws, spark, rows, dimensions=2).rows.collect()
    assert [(r.cluster, r.distance, r.inertia) for r in got] == [(0, 0, 0)] * 5  # ties go to the first of equal centroids
    rows = [(1, [3e38, -3e38]), (2, [0.0, 0.0])]
    got = {r.vec_id: r for r in run(ws, spark, rows, dimensions=2, clusters=1, rounds=0).rows.collect()}
    assert sorted(r.distance for r in got.values()) == [0, 2 * LARGEST**2]
    rows = [(i, [3e38] * 64 if i else [-3e38] * 64) for i in range(3)]
    found = run(ws, spark, rows, clusters=1, rounds=0).rows.collect()
    assert max(r.distance for r in found) == 1 << 62 and len(found) == 3
    assert run(ws, spark, rows * 2, clusters=1, rounds=0).rows.where("inertia is null").count() == 6


def test_nothing_to_cluster(spark, ws):
    for rows in ([], [(1, None), (2, [1.0])]):
        found = run(ws, spark, rows)
        assert found.rows.collect() == [] and found.centroids == []
        assert found.rows.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]
