"""Integer k-means against a plain version, and the filter's bounds."""

import hashlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from compare import difference
from terrier.llm import centroids, queries
from terrier.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, scale=1024, seed="3"):
    """Clusters by full distances in Python integers: (id, cluster, distance), centroids."""
    points = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows]
    name = lambda p: (hashlib.sha256(f"{seed}:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1])
    cents = [v for _, v in sorted(points, key=name)[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [[] for _ in cents]
        for _, v in points:
            own[nearest(v)[0]].append(v)
        cents = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for c, vs in zip(cents, own)]
    return [(i, *nearest(v)) for i, v in points], cents


def check(spark, rows, k, rounds, dimensions):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = centroids.clustered(frame, k=k, rounds=rounds, dimensions=dimensions).collect()
    want, cents = plain(rows, k, rounds)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted(((r.id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.centroid == cents[r.cluster]
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for *_, d in want)


def test_the_filter_never_loses_the_nearest():
    chance = np.random.default_rng(1)
    for _ in range(400):
        n_dimensions, k = int(chance.integers(1, 12)), int(chance.integers(1, 9))
        size = int(chance.choice([2, 50, 2000, 2**24]))
        points = chance.integers(-size, size + 1, (200, n_dimensions))
        first = points[chance.integers(0, 200, k)]
        simplex = centroids.Simplex(first)
        moved = centroids.Centroids(simplex, first + chance.integers(-2, 3, first.shape))
        exact = ((points[:, None] - moved.centroids) ** 2).sum(2)
        assert (moved.nearest(points, simplex.apexes(points)[0]) == exact.argmin(1)).all()


def test_bounds_enclose_the_distance_and_spare_most_exact_ones():
    chance = np.random.default_rng(2)
    middles = chance.normal(0, 1, (8, 64)) * 1000
    points = np.floor(middles[chance.integers(0, 8, 3000)] + chance.normal(0, 1, (3000, 64)) * 200).astype(np.int64)
    simplex = centroids.Simplex(np.floor(middles).astype(np.int64))
    cents = centroids.Centroids(simplex, simplex.pivots + 5)
    apexes, _ = simplex.apexes(points)
    exact = ((points[:, None] - cents.centroids) ** 2).sum(2)
    flat = ((apexes[:, None, :-1] - cents.apexes[:, :-1]) ** 2).sum(2)
    low = flat + (apexes[:, -1:] - cents.apexes[:, -1]) ** 2
    high = flat + (apexes[:, -1:] + cents.apexes[:, -1]) ** 2
    assert (low <= exact * (1 + 1e-6) + 1).all() and (high >= exact * (1 - 1e-6) - 1).all()
    assert (cents.candidates(apexes).sum(1) == 1).mean() > 0.9


def test_equals_the_plain_version(spark):
    chance = np.random.default_rng(3)
    rows = [(i, [float(x) for x in chance.normal(0, 1, 5)]) for i in range(300)]
    rows += [(1000 + i, [0.5, -0.25, 0.0, 1.0, -1.0]) for i in range(200)]  # a hot vector
    rows += [(7, [1.0] * 5), (7, [2.0] * 5), (None, [0.0] * 5), (None, [0.0] * 5)]
    check(spark, rows, 8, 10, 5)


def test_equal_first_centroids_and_few_vectors(spark):
    check(spark, [(i, [1.0, 2.0]) for i in range(20)], 4, 3, 2)
    check(spark, [(1, [1.0, 2.0]), (2, [1.5, -2.0])], 8, 10, 2)
    check(spark, [(i, [float(i)]) for i in range(30)], 3, 2, 1)


def test_odd_vectors_are_left_out(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]),
            (7, [1.0, float("nan")]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 3.0]), (10, [0.0, -0.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cluster int, id string")
    got = centroids.clustered(frame, k=2, dimensions=2).collect()
    assert sorted(r.id for r in got) == [1, 2, 10]
    assert centroids.clustered(frame.where("vec_id > 2 and vec_id < 9"), k=2, dimensions=2).collect() == []


def test_vectors_too_large_for_exact_distances_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e9, 0.0]), (2, [0.0, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.clustered(frame, k=2, dimensions=2).collect()


def test_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{Path(FOLDER)}/embeddings.parquet'")
    assert difference(queries.op13_centroids(spark, FOLDER), con, ORACLES["op13_centroids"]) == ""
