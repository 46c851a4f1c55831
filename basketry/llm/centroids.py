"""Centroid clustering of integer vectors, the nearest centroid found by the threshold algorithm.

For each dimension the centroids stand in a list sorted by their component. A vector walks every list outward from its own
component, nearest component first. A centroid met in any list gets its exact distance. The squares of the distances at
the frontiers of all lists add up to a bound for the centroids that no list has shown yet; as soon as it strictly exceeds the
best exact distance, none of them can win or tie, and the walk ends.

Each round is one pass over the vectors as they stand in the table, with sums per task and cluster before the shuffle. Only the
centroids (a fixed number of fixed length) come to the driver and go to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import stage_table, table

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
#: Vectors walked at a time.
ROWS = 512
#: Components beyond this would not fit a long and stand at its end; distances stop at the longest long.
FARTHEST = 1 << 62
LONGEST = (1 << 63) - 1
#: Components up to this have distances that fit a long whatever the vectors are: 64 * (2 * 2**27)**2 = 2**62.
EXACT = 1 << 27


class Lists:
    """Centroids (k, d) with one sorted list per dimension. Numbers too wide for 64 bits are walked as Python's own."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.ids = np.argsort(centroids, axis=0, kind="stable").T  # (d, k)
        self.values = np.take_along_axis(centroids.T, self.ids, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector; the smaller number wins a tie."""
        if max(np.abs(vectors).max(initial=0), np.abs(self.centroids).max(initial=0)) > EXACT:
            wide = Lists(self.centroids.astype(object))
            return wide._walk(vectors.astype(object))
        return self._walk(vectors)

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, (dims, k) = len(vectors), self.ids.shape
        kind = self.centroids.dtype
        never = LONGEST if kind != object else 1 << 200
        distance = np.full((rows, k), never, kind)
        # right: the first entry of a list that is not below the vector's component; left: the one before it.
        right = np.stack([np.searchsorted(self.values[d], vectors[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        lists = np.arange(dims)
        active = np.arange(rows)
        for _ in range(k):
            x, lo, hi = vectors[active], left[active], right[active]
            below = np.where(lo >= 0, x - self.values[lists, np.maximum(lo, 0)], never)
            above = np.where(hi < k, self.values[lists, np.minimum(hi, k - 1)] - x, never)
            down = below <= above
            frontier = np.where(down, below, above)
            met = self.ids[lists, np.where(down, lo, np.minimum(hi, k - 1))]
            left[active] = lo - down
            right[active] = hi + ~down
            new = np.zeros((len(active), k), bool)
            new[np.arange(len(active))[:, None], met] = True
            new &= distance[active] == never
            at, centroid = np.nonzero(new)
            away = x[at] - self.centroids[centroid]
            distance[active[at], centroid] = (away * away).sum(axis=1)
            bound = (frontier * frontier).sum(axis=1)
            active = active[~(bound > distance[active].min(axis=1))]
            if not len(active):
                break
        best = distance.argmin(axis=1)  # the first of equal ones
        return best, distance[np.arange(rows), best]


def integer_vectors(batch: pa.RecordBatch, scale: int = SCALE, dims: int = DIMENSIONS) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(keys, whole components) of the vectors of (key, vector) rows that are kept, some hundreds at a time.

    Kept are vectors of `dims` components that are all numbers: no null, no infinity, no NaN.
    """
    whole = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
    batch = batch.filter(whole)
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        flat = pc.list_flatten(part.column(1)).cast(pa.float64())
        values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
        finite = np.isfinite(values).all(axis=1)
        with np.errstate(over="ignore"):
            floors = np.floor(scale * values[finite])
        # Doubles next to 2**62 are 2**62 itself, so the clipped ones still fit.
        yield part.column(0).filter(pa.array(finite)), np.clip(floors, -float(FARTHEST), float(FARTHEST)).astype(np.int64)


def _pairs(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))


def first_centroids(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of seed and key, in order of the hash; of equal keys the smaller vector first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in integer_vectors(batch):
                made = pa.array(list(values), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, made], names=["key", "parts"])

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    kept = _pairs(vectors, key, vector).mapInArrow(run, "key long, parts array<long>")
    chosen = kept.orderBy(F.sha2(name.cast("binary"), 256), "parts").limit(clusters).collect()
    return np.array([row.parts for row in chosen], np.int64).reshape(-1, DIMENSIONS)


def assign(vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, cluster, distance) per kept vector. Without centroids there is no row."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(shared.value)
        for batch in batches:
            for keys, values in integer_vectors(batch):
                if len(values) and len(shared.value):
                    cluster, distance = lists.nearest(values)
                    columns = [keys, pa.array(cluster, pa.int32()), pa.array(np.minimum(distance, LONGEST).astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "distance"])

    return _pairs(vectors, key, vector).mapInArrow(run, "key long, cluster int, distance long").withColumnRenamed("key", key)


def refine(vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """One round: every vector to its nearest centroid, every non-empty centroid to the floor of its vectors' mean.

    A task adds up its vectors per cluster before the shuffle, so a cluster of any size is one row per task and dimension.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    # Sums of a task are kept in two halves of 32 bits each, so that they cannot overflow before they become decimals.
    low = (1 << 32) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, k = Lists(shared.value), len(shared.value)
        upper, lower = np.zeros((k, DIMENSIONS), np.int64), np.zeros((k, DIMENSIONS), np.int64)
        counts = np.zeros(k, np.int64)
        for batch in batches:
            for _, values in integer_vectors(batch):
                if len(values) and k:
                    cluster, _ = lists.nearest(values)
                    np.add.at(upper, cluster, values >> 32)
                    np.add.at(lower, cluster, values & low)
                    counts += np.bincount(cluster, minlength=k)
        used = np.nonzero(counts)[0]
        cells = [(int(c), d, int(upper[c, d]), int(lower[c, d]), int(counts[c])) for c in used for d in range(DIMENSIONS)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        if cells:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*cells), kinds)], names=["cluster", "dim", "hi", "lo", "n"])

    sums = _pairs(vectors, key, vector).mapInArrow(run, "cluster int, dim int, hi long, lo long, n long")
    big = "decimal(38,0)"
    cells = sums.groupBy("cluster", "dim").agg(
        F.sum(F.col("hi").cast("decimal(20,0)")).cast(big).alias("hi"), F.sum(F.col("lo").cast("decimal(20,0)")).cast(big).alias("lo"), F.sum("n").alias("n"))
    after = centroids.copy()
    for cell in cells.collect():  # at most clusters * dimensions rows
        after[cell.cluster, cell.dim] = (int(cell.hi) * (low + 1) + int(cell.lo)) // cell.n
    return after


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS, clusters: int = CLUSTERS) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) per kept vector.

    Null, short, long and non-finite vectors have no row; a null key counts as an empty one in the choice of the first
    centroids; rows of equal keys are clustered each by itself; fewer vectors than clusters give as many centroids; an empty table gives an
    empty one. Columns besides the two named are not read. Components and distances that a long cannot hold stand at its end.
    """
    centroids = first_centroids(vectors, key, vector, clusters)
    for _ in range(rounds):
        centroids = refine(vectors, centroids, key, vector)
    assigned = stage_table(assign(vectors, centroids, key, vector))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()  # one row per cluster
    inertia = {row.cluster: int(row.total) for row in sums}
    longs = [str(min(inertia.get(c, 0), LONGEST)) + "L" for c in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids.tolist()]

    def of_cluster(values: list[str], kind: str):
        return F.element_at(F.expr(f"cast(array({', '.join(values)}) as array<{kind}>)"), F.col("cluster") + 1)

    return assigned.withColumns({
        "cluster_inertia": of_cluster(longs, "bigint"),
        "inertia": F.lit(min(sum(inertia.values()), LONGEST)).cast("long"),
        "centroid_sha256": of_cluster([f"'{mark}'" for mark in marks], "string"),
    })


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of `embeddings` with cluster, distance and inertia."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same rounds for DuckDB: every vector against every centroid."""
    steps = [f"""
kept as (
    select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v,
        row_number() over (order by sha256('{SEED}:' || coalesce(vec_id::varchar, '')), embedding) as place, row_number() over () as row_id
    from embeddings
    where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMENSIONS}
), c0 as (select (place - 1)::int as c, v as m from kept where place <= {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} as materialized (
    select row_id, min((d, c)) as best from (
        select row_id, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from kept, c{i}
    ) group by row_id
)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} as (
    select c, list(floored order by dim) as m from (
        select c, dim, ((s - ((s % n) + n) % n) // n)::bigint as floored from (
            select best[2] as c, dim, sum(v[dim])::hugeint as s, count(*)::hugeint as n
            from a{i} join kept using (row_id), (select unnest(range(1, {DIMENSIONS + 1})) as dim) group by 1, 2
        )
    ) group by c
), c{i + 1} as materialized (select c{i}.c, coalesce(s{i}.m, c{i}.m) as m from c{i} left join s{i} on c{i}.c = s{i}.c)""")
    return "with" + ",".join(steps) + f"""
select vec_id, best[2]::int as cluster, best[1]::bigint as distance, (sum(best[1]) over (partition by best[2]))::bigint as cluster_inertia,
    (sum(best[1]) over ())::bigint as inertia, sha256(array_to_string(m, ',')) as centroid_sha256
from a{ROUNDS} join kept using (row_id) join c{ROUNDS} on c{ROUNDS}.c = best[2]
"""


OP12_SQL = _oracle()
