"""Exact integer k-means whose assignments are filtered by an n-simplex projection.

Vectors of exactly ``dimensions`` finite components become integers floor(``scale`` * x). The first
centroids are the kept vectors of smallest SHA-256 of ``seed:id``; each round assigns every vector to
the nearest centroid (squared Euclidean distance, ties to the smaller number) and moves every centroid
that has vectors to their componentwise floor(sum / count).

**Projection.** Pivots are first centroids in general position. The distances of a vector to the n
pivots fix an apex over the simplex of the pivots: n - 1 coordinates in its base and an altitude. They
are computed once from exact squared distances and stored with the integers. For two apexes the distance
with altitudes on the same side is a lower bound of the true distance, with altitudes on opposite sides
an upper bound. A centroid whose lower bound exceeds the smallest upper bound by more than
``MARGIN`` (far above rounding) cannot be nearest. Where several are left, ties included,
their exact integer distances decide; where one is left, no full distance is computed.

Each round reads the stored table without a shuffle; a task sends one row a cluster (count and sums), which
Spark adds up, and only the k centroids pass the driver. A round that moves nothing ends the loop, as all
later ones would repeat it. Memory of a task is one Arrow batch, however large a cluster is.

Nulls and odd input: vectors that are null, of another length, or with a null, NaN or infinite component
are not returned. A null id counts as empty text in the hash; equal hashes are ordered by the vector.
Equal first centroids are allowed, the later one stays empty. Fewer vectors than k: as many centroids as
vectors; an empty table gives no rows. Components must be small enough for 64-bit distances
(131,072 with 64 components at a scale of 1,024), others raise ValueError. Only id and vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.session import written

MARGIN = 1e-6
ROWS = 4096
#: A pivot must stand at least this far (relative to its distance) outside the span of those before.
_APART = 0.05


class Simplex:
    """Pivots, and the projection of integer vectors to apexes over them."""

    def __init__(self, candidates: np.ndarray):
        chosen, base = [0], np.zeros((1, 0))
        for i in range(1, len(candidates)):
            self.pivots, self.base = candidates[chosen], base
            apex, far = self.apexes(candidates[i : i + 1])
            if apex[0, -1] ** 2 > _APART**2 * far[0] and far[0] > 0:
                chosen.append(i)
                base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apex])
        self.pivots, self.base = candidates[chosen], base

    def apexes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the base with the altitude last, and squared distances to the first pivot."""
        squared = np.stack([squares(vectors - p) for p in self.pivots], 1).astype(float)
        inner = self.base[1:]
        halves = (squared[:, :1] - squared[:, 1:] + (inner**2).sum(1)) / 2
        flat = np.linalg.solve(inner, halves.T).T if len(inner) else halves
        height = np.sqrt(np.maximum(squared[:, 0] - (flat**2).sum(1), 0))
        return np.hstack([flat, height[:, None]]), squared[:, 0]


def squares(difference: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", difference, difference)


class Centroids:
    """Finds the nearest of some centroids."""

    def __init__(self, simplex: Simplex, centroids: np.ndarray):
        self.centroids = centroids
        self.apexes, far = simplex.apexes(centroids)
        self.far = far.max()

    def candidates(self, apexes: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest to each apex."""
        flat = np.zeros((len(apexes), len(self.centroids)))
        for c, own in enumerate(self.apexes):
            flat[:, c] = ((apexes[:, :-1] - own[:-1]) ** 2).sum(1)
        height, heights = apexes[:, -1:], self.apexes[:, -1]
        lower, upper = flat + (height - heights) ** 2, flat + (height + heights) ** 2
        room = MARGIN * ((apexes**2).sum(1) + self.far + 1)
        return lower <= (upper.min(1) + room)[:, None]

    def nearest(self, vectors: np.ndarray, apexes: np.ndarray) -> np.ndarray:
        left = self.candidates(apexes)
        found = left.argmax(1)
        several = np.flatnonzero(left.sum(1) > 1)
        if len(several):
            row, c = np.nonzero(left[several])
            exact = np.full((len(several), len(self.centroids)), np.iinfo(np.int64).max)
            exact[row, c] = squares(vectors[several[row]] - self.centroids[c])
            found[several] = exact.argmin(1)
        return found


def _numbers(column, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _lists(numbers: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(numbers) + 1, dtype=np.int32) * numbers.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel()))


def projected(kept: DataFrame, simplex: Simplex, scale: int) -> DataFrame:
    """``id``, integer ``vector`` and ``apex`` of all vectors."""
    n_dimensions = simplex.pivots.shape[1]
    limit = 2 ** ((62 - (n_dimensions - 1).bit_length()) // 2 - 1)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                vectors = np.floor(scale * _numbers(batch.column(1), n_dimensions, np.float64))
                if np.abs(vectors).max() > limit:
                    raise ValueError(f"a component is beyond {limit / scale}")
                vectors = vectors.astype(np.int64)
                yield pa.record_batch(
                    [batch.column(0), _lists(vectors), _lists(simplex.apexes(vectors)[0])],
                    ["id", "vector", "apex"])

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(local, f"id {kind}, vector array<bigint>, apex array<double>")


def _sums(points: DataFrame, nearest: Centroids) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sums of the vectors of every cluster that has any."""
    k, n_dimensions = nearest.centroids.shape
    n_apex = nearest.apexes.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, n_dimensions), np.int64)
        for whole in batches:
            for batch in _batches(whole):
                vectors = _numbers(batch.column(0), n_dimensions, np.int64)
                found = nearest.nearest(vectors, _numbers(batch.column(1), n_apex, np.float64))
                counts += np.bincount(found, minlength=k)
                for c in np.unique(found):
                    sums[c] += vectors[found == c].sum(0)
        own = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(own, pa.int64()), pa.array(counts[own]), _lists(sums[own])], ["cluster", "n", "sums"])

    rows = points.select("vector", "apex").mapInArrow(
        local, "cluster long, n long, sums array<bigint>").groupBy("cluster").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(n_dimensions)])
    return {row[0]: (row[1], list(row[2:])) for row in rows.collect()}  # k rows at most


def _assigned(points: DataFrame, nearest: Centroids) -> DataFrame:
    n_dimensions, n_apex = nearest.centroids.shape[1], nearest.apexes.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                vectors = _numbers(batch.column(1), n_dimensions, np.int64)
                found = nearest.nearest(vectors, _numbers(batch.column(2), n_apex, np.float64))
                yield pa.record_batch(
                    [batch.column(0), pa.array(found, pa.int32()),
                     pa.array(squares(vectors - nearest.centroids[found]))], ["id", "cluster", "distance"])

    kind = points.schema["id"].dataType.simpleString()
    return points.select("id", "vector", "apex").mapInArrow(
        local, f"id {kind}, cluster int, distance long")


def first_centroids(kept: DataFrame, k: int, scale: int, seed: str) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
                    .cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), "embedding").orderBy("digest", "embedding").limit(k).collect()
    return np.floor(scale * np.array([r.embedding for r in rows], np.float64)).astype(np.int64)


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64,
              scale: int = 1024, seed: str = "3", n_pivots: int = 8, id_column: str = "vec_id",
              vector_column: str = "embedding") -> DataFrame:
    """``id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid`` and its digest.

    ``distance`` is squared; inertias are its sums over the cluster and over all. Runs jobs.
    """
    spark = vectors.sparkSession
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("embedding")).filter(
        (F.size("embedding") == dimensions) & sound)
    centroids = first_centroids(kept, k, scale, seed)
    if not len(centroids):
        return kept.select("id", *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid", "array<bigint>"), ("centroid_sha256", "string"))])
    simplex = Simplex(centroids[: max(1, n_pivots)])
    points = written(projected(kept, simplex, scale), "apexes")
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, sums) in _sums(points, Centroids(simplex, centroids)).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break
        centroids = moved
    found = written(_assigned(points, Centroids(simplex, centroids)), "clusters")
    inertias = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(c, s, sum(inertias.values()), centroids[c].tolist(),
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c, s in inertias.items()]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, "
                                     "centroid array<bigint>, centroid_sha256 string")
    return found.join(F.broadcast(clusters), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
