"""Centroid clustering of vectors in whole numbers: pivots' distances bound each distance to a centroid before it is worked out.

The distances from m pivots fix a point's apex over the simplex of the pivots, m coordinates. The Euclidean distance of two
apexes is no more than that of the points, and with the last coordinate of one of them turned it is no less. A centroid
whose lower bound is above the least upper bound cannot be the nearest; the others are compared in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import map_arrow, release, settle

SCALE = 256
LIMIT = 1 << 27  # components are held to this size, so that squared distances of 64 to 128 components fit a long
PIVOTS = 8
THIN = 1e-2  # a pivot is taken if it stands this far off the others' simplex, as a share of the largest distance
SLACK = 1e-6  # of the squared distances: far more than the bounds can be off by rounding


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers to one of them."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


@dataclass(frozen=True)
class Simplex:
    """Pivots, and the corners of their simplex beside the first, which is the origin: a lower triangle."""

    pivots: np.ndarray
    corners: np.ndarray

    @staticmethod
    def of(points: np.ndarray, most: int = PIVOTS) -> Simplex:
        """The first point, and each time the one farthest off the simplex so far, while it is not flat."""
        simplex = Simplex(points[:1], np.zeros((0, 0)))
        while len(simplex.pivots) < most:
            apexes = simplex.apexes(simplex.distances(points))
            far = int(np.argmax(apexes[:, -1]))
            if apexes[far, -1] <= THIN * math.sqrt(max(float(squared(points, points[0]).max()), 1.0)):
                break
            wider = np.zeros((len(simplex.pivots), len(simplex.pivots)))
            wider[:-1, :-1] = simplex.corners
            wider[-1] = apexes[far]
            simplex = Simplex(np.vstack([simplex.pivots, points[far]]), wider)
        return simplex

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Exact squared distances to each pivot."""
        return np.stack([squared(points, p) for p in self.pivots], axis=1)

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates of points with these squared distances; the last one is their height over the simplex."""
        d = distances.astype(np.float64)
        sides = (self.corners**2).sum(axis=1)
        flat = np.linalg.solve(self.corners, ((sides + d[:, :1] - d[:, 1:]) / 2).T).T if len(sides) else np.zeros((len(d), 0))
        height = np.sqrt(np.maximum(d[:, 0] - (flat**2).sum(axis=1), 0))
        return np.column_stack([flat, height])


def nearest(points: np.ndarray, cached: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each point's nearest centroid (of equally near ones the first), its squared distance, and how many were compared."""
    known = simplex.distances(centroids)
    x, c = simplex.apexes(cached), simplex.apexes(known)
    beside = ((x[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
    slack = SLACK * (1 + cached.max(axis=1)[:, None] + known.max(axis=1)[None, :])
    lower = beside + (x[:, None, -1] - c[None, :, -1]) ** 2 - slack
    upper = beside + (x[:, None, -1] + c[None, :, -1]) ** 2 + slack
    open_ = lower <= upper.min(axis=1, keepdims=True)
    best, cluster = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int32)
    for j in range(len(centroids)):
        rows = np.flatnonzero(open_[:, j])
        d = squared(points[rows], centroids[j])
        closer = d < best[rows]
        best[rows[closer]], cluster[rows[closer]] = d[closer], j
    return cluster, best, open_.sum(axis=1).astype(np.int32)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, v`` of the vectors with ``dims`` finite components, each made ``floor(scale * x)``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return rows.filter((F.size("v") == dims) & finite).select("id", whole.alias("v"))


def _points(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().astype(np.int64).reshape(-1, width)


def _with_distances(whole: DataFrame, simplex: Simplex, dims: int) -> DataFrame:
    """``whole`` with the squared distances to the pivots, worked out once for all rounds."""
    width = len(simplex.pivots)

    def run(batches):
        for batch in batches:
            d = simplex.distances(_points(batch, "v", dims))
            offsets = np.arange(0, d.size + 1, width, dtype=np.int32)
            far = pa.ListArray.from_arrays(pa.array(offsets), pa.array(d.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, far], [*batch.schema.names, "far"])

    return map_arrow(whole, run, whole.withColumn("far", F.array().cast("array<long>")).schema)


def _placed(batches, centroids: np.ndarray, simplex: Simplex) -> Iterator[tuple]:
    dims, width = centroids.shape[1], len(simplex.pivots)
    for batch in batches:
        points = _points(batch, "v", dims)
        yield batch, points, *nearest(points, _points(batch, "far", width), centroids, simplex)


def _moved(rows: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """One round: every task sums its vectors by centroid; the sums, one row a centroid and task, are added up by Spark."""
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, points, cluster, _, _ in _placed(batches, centroids, simplex):
            np.add.at(sums, cluster, points)
            counts += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    parts = map_arrow(rows.select("v", "far"), run, "cluster long, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    after = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        after[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dims)]
    return after


def _named(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]


def first_centroids(whole: DataFrame, k: int, order: Column) -> np.ndarray:
    """The ``k`` vectors that come first; equal places are settled by the components."""
    rows = whole.select("v", order.alias("place")).orderBy(F.col("place").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = SCALE, seed: str = "2"
) -> DataFrame:
    """``id, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256`` for every vector that is kept.

    Vectors with another number of components, or with one that is null or not finite, are left out; components are held to
    2^27 in size after scaling. The first centroids are the kept vectors with the smallest SHA-256 of ``seed:id``; rows without
    an id come last, equal hashes by their components; fewer vectors than ``k`` are as many centroids. Each round
    assigns every vector and moves each centroid that has any to the floor of their mean, exactly. Ties go to the smaller
    number; inertias beyond a long are null. ``compared`` counts the centroids that the bounds left open. Repeated rows count as often as they stand. An
    empty table gives no rows. The driver holds ``k`` vectors and nothing that grows with the table.
    """
    whole = settle(whole_vectors(vectors, id_col, vector_col, dims, scale))
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    centroids = first_centroids(whole, k, place)
    kind = whole.schema["id"].dataType.simpleString()
    told = "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string"
    if not len(centroids):
        empty = f"id {kind}, cluster int, distance long, compared int, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    simplex = Simplex.of(centroids)
    rows = settle(_with_distances(whole, simplex, dims))
    release(whole)
    for _ in range(rounds):
        centroids = _moved(rows, centroids, simplex)

    def run(batches):
        for batch, _, number, distance, compared in _placed(batches, centroids, simplex):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(number), pa.array(distance), pa.array(compared)], ["id", "cluster", "distance", "compared"]
            )

    found = settle(map_arrow(rows, run, f"id {kind}, cluster int, distance long, compared int"))
    release(rows)
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names, total = _named(centroids), sum(sums.values())
    ends = vectors.sparkSession.createDataFrame([(c, Decimal(s), Decimal(total), names[c]) for c, s in sums.items()], told)
    ends = ends.withColumns({c: F.col(c).try_cast("long") for c in ("cluster_inertia", "inertia")})
    return found.join(F.broadcast(ends), "cluster").select("id", "cluster", "distance", "compared", *ends.columns[1:])
