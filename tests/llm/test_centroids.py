"""Clustering against plain Python, the walk against all distances, odd vectors, SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from basketry.llm import centroids

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("spread", [2, 30, 2**27, 2**40, 2**62])
def test_walk_equals_all_distances(spread):
    draw = np.random.default_rng(spread % 97)
    middle, vectors = draw.integers(-spread, spread, (40, 64)), draw.integers(-spread, spread, (300, 64))
    vectors[:4], middle[9] = middle[3:7], middle[4]
    plain = ((vectors.astype(object)[:, None] - middle.astype(object)[None]) ** 2).sum(2)
    cluster, distance = centroids.Lists(middle).nearest(vectors)
    assert (cluster == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def test_walk_stops_early():
    """Centroids apart in every dimension: the others are never measured."""
    middle = np.arange(40)[:, None] * np.full((1, 64), 1000)
    measured = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.ndim == 1:
                measured.append(len(at))
            return super().__getitem__(at)

    lists = centroids.Lists(middle)
    lists.centroids = middle.view(Counting)
    cluster, _ = lists.nearest(middle[[5, 17]] + 1)
    assert cluster.tolist() == [5, 17] and sum(measured) < 2 * 5


def plain_clusters(rows, rounds=centroids.ROUNDS):
    kept = [(k, [min(max(math.floor(256 * x), -(2**62)), 2**62) for x in v]) for k, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in named[:40]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, vs in groups.items():
            middle[c] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(k, *nearest(v)) for k, v in kept]
    top = 2**63 - 1
    of_cluster = {c: sum(min(d, top) for _, d, x in found if x == c) for _, _, c in found}
    return sorted((str(k), c, min(d, top), min(of_cluster[c], top), min(sum(of_cluster.values()), top),
                   hashlib.sha256(",".join(map(str, middle[c])).encode()).hexdigest()) for k, d, c in found)


def result(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def odd_vectors():
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=64).round(2).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (200, rows[3][1]), (None, rows[1][1]), (201, [0.0] * 64), (202, [-0.001] * 64)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63), (305, [math.nan] * 64), (306, [math.inf] + [0.0] * 63)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, key string, cluster string, distance string, vector string"


@pytest.mark.parametrize("extreme", [[], [(400, [1e30] * 64), (401, [-1e30] * 64), (402, [1e5] * 64)]])
def test_equals_plain_python(spark, odd_vectors, extreme):
    rows = odd_vectors + extreme
    df = spark.createDataFrame([(k, v, 0, "x", "x", "x", "x") for k, v in rows], SCHEMA).repartition(3)
    assert result(centroids.cluster(df)) == plain_clusters(rows)


def test_few_and_no_vectors(spark, odd_vectors):
    few = spark.createDataFrame([(k, v, 0, "x", "x", "x", "x") for k, v in odd_vectors[:5]], SCHEMA)
    assert result(centroids.cluster(few)) == plain_clusters(odd_vectors[:5])
    assert centroids.cluster(few.limit(0)).count() == 0
    assert centroids.cluster(few.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_query_equals_sql(spark):
    with duckdb.connect() as db:
        db.execute(f"create view embeddings as from '{FOLDER}/embeddings.parquet'")
        want = db.sql(centroids.OP12_SQL).fetchall()
    assert result(centroids.op12_centroids(spark, FOLDER)) == sorted((str(k), *rest) for k, *rest in want)
