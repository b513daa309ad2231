"""Clusters of integer vectors around centroids, in expressions that the JVM evaluates.

A vector is an array of whole numbers. ``zip_with`` and ``aggregate`` give its
products with arrays of literals, one per centroid, from which the squared
distance follows without rounding; ``array_min`` over structs of distance and
number picks the cluster. A round is one reading of the vectors that adds up
each component by cluster, so what is shuffled and fetched is one row per
cluster and task, however the vectors are spread. The vectors stay where they are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starrung.workspace import Workspace

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
# Components beyond this are set to it: products of 64 of them and sums over 2^35 vectors stay within a long.
LARGEST = 1 << 27


@dataclass(frozen=True)
class Clustering:
    """``rows`` have the key, ``cluster, distance, cluster_inertia, inertia``; ``centroids`` are the final ones by number."""

    rows: DataFrame
    centroids: list[list[int]]

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components as decimal numbers, joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def integer_vectors(vectors: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``row, v`` of the vectors with ``dimensions`` components that are all finite numbers; ``v`` is floor(scale * x)."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda e: F.greatest(F.least(F.floor(e * float(scale)), F.lit(LARGEST)), F.lit(-LARGEST)))
    rows = vectors.where((F.size(vector) == dimensions) & finite)
    return rows.select(F.col(key).alias("row"), whole.cast("array<long>").alias("v"))


def _literal(numbers: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{n}L' for n in numbers)})")


def _product(left: Column, right: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), zero, lambda total, x: total + x)


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``rows`` with ``cluster``, the nearest centroid (of equally near ones the first), and ``distance``, squared."""
    v = F.col("v")
    # (v - c)^2 = v^2 - 2 v c + c^2, and v^2 is the same for all centroids.
    reach = F.array_min(F.array(*[
        F.struct((F.lit(sum(x * x for x in c)) + _product(v, _literal([-2 * x for x in c]))).alias("reach"),
                 F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))
    rows = rows.withColumn("reach", reach)
    return rows.withColumns({"cluster": F.col("reach.cluster"),
                             "distance": F.col("reach.reach") + _product(v, v)}).drop("reach")


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of seed and key; rows that repeat a key go by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row").cast("string"), F.lit("")))
    order = F.sha2(name.cast("binary"), 256)
    return [list(r.v) for r in rows.select(order.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()]


def _moved(rows: DataFrame, centroids: list[list[int]], dimensions: int) -> list[list[int]]:
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dimensions)]
    found = assigned(rows, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    out = list(centroids)
    for r in found:  # a row per cluster
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dimensions)]
    return out


def cluster_vectors(ws: Workspace, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    dimensions: int = DIMENSIONS, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    seed: int = SEED) -> Clustering:
    """A row per vector with exactly ``dimensions`` components, none of them null, NaN or infinite.

    Components are floor(scale * x), at most ``LARGEST`` in size. Every round
    assigns all vectors and moves each centroid to the floor of its vectors'
    mean; a centroid without vectors stays. Vectors are assigned once more in
    the end. With fewer vectors than ``clusters`` each is a first centroid.
    Repeated rows count as often as they occur, a null key as an empty one;
    other columns are ignored. Without usable vectors there are no rows and no
    centroids. An inertia beyond the range of a long is null.
    """
    rows = integer_vectors(vectors, key, vector, dimensions, scale)
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        none = rows.select(F.col("row").alias(key), F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return Clustering(none, [])
    for _ in range(rounds):
        centroids = _moved(rows, centroids, dimensions)
    found = ws.table(assigned(rows, centroids).select("row", "cluster", "distance"), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d"))
    inertia = {r.cluster: int(r.d) for r in sums.collect()}
    by_cluster = F.array(*[_long(inertia.get(i, 0)) for i in range(len(centroids))])
    return Clustering(found.select(
        F.col("row").alias(key), "cluster", "distance", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        _long(sum(inertia.values())).alias("inertia")), centroids)


def _long(number: int) -> Column:
    return F.lit(number if number < 1 << 63 else None).cast("long")
