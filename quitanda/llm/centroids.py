"""Operator 13: k-means on integer vectors, nearest centroids by the threshold algorithm.

Method: for each dimension the centroids' values are one sorted list.  A vector
stands somewhere in each list and walks outward from there, the nearer side
first; a centroid met in any list gets its exact distance.  What a list has not
shown yet lies at least as far as its frontier, so no unseen centroid is nearer
than the sum of the squared frontier distances.  The walk stops when that sum
strictly exceeds the best exact distance (strictly, because a centroid with a
smaller number may still tie).

Spark partitions the vectors; a task walks a block of them at a time and keeps
one sum per centroid and dimension, so a cluster that holds most rows is summed
before anything is shuffled.  Only the centroids (k times dims numbers) reach the
driver and the tasks.  All arithmetic is in integers and sums are decimals, so
results do not depend on partitioning.

Defined cases: vectors that are null, have another number of components than
``dims``, or hold a null or non-finite component take no part; rows that repeat a
vec_id are separate vectors, and of equal hashes the smaller vector starts first;
rows with a null vec_id take part, but start a centroid only after all others;
fewer vectors than ``k`` give fewer centroids; an empty table gives an empty
result; a component outside +-2^27 after scaling raises ValueError, because a
distance might not fit a long.  Only ``id_col`` and ``vec_col`` are read, so
other columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import stored

CLUSTERS = 16
ROUNDS = 3
SCALE = 64
DIMS = 64
#: Vectors walked at a time.
BLOCK = 1024
#: Largest scaled component: squared distances over 64 dimensions stay below 2^63.
LARGEST = 1 << 27
#: Vectors after which a task hands on its sums, so that they fit a long.
SUM_ROWS = 1 << 24
_FAR = np.iinfo(np.int64).max


def quantised(vectors: pa.Array, scale: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that count, their components floor(scale * x))."""
    size = np.asarray(pc.list_value_length(vectors).fill_null(-1))
    rows = np.flatnonzero(size == dims)
    flat = pc.list_flatten(vectors.take(pa.array(rows)))
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dims)
    good = np.isfinite(x).all(axis=1)
    scaled = np.floor(scale * x[good])
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a scaled component exceeds {LARGEST}; distances might not fit a long")
    return rows[good], scaled.astype(np.int64)


def nearest(block: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid; ties go to the smaller number."""
    n, dims = block.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    # one value before and behind each list stands for its end
    lists = np.take_along_axis(centroids, order, axis=0)
    dim = np.arange(dims)
    high = np.empty((n, dims), np.int64)
    for d in range(dims):
        high[:, d] = np.searchsorted(lists[:, d], block[:, d])
    low = high - 1
    best, number = np.full(n, _FAR), np.full(n, k)
    seen = np.zeros((n, k), bool)
    active = np.arange(n)

    def gap(at: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        value = lists[np.clip(at, 0, k - 1), dim]
        return np.where((at >= 0) & (at < k), np.abs(vectors - value), _FAR)

    while len(active):
        vectors, lo, hi = block[active], low[active], high[active]
        below = gap(lo, vectors) <= gap(hi, vectors)
        met = order[np.where(below, lo, hi), dim]
        lo, hi = lo - below, hi + ~below
        low[active], high[active] = lo, hi
        fresh = np.zeros((len(active), k), bool)
        np.put_along_axis(fresh, met, True, axis=1)
        fresh &= ~seen[active]
        seen[active] |= fresh
        for c in np.flatnonzero(fresh.any(axis=0)):
            rows = np.flatnonzero(fresh[:, c])
            away = ((vectors[rows] - centroids[c]) ** 2).sum(axis=1)
            who = active[rows]
            better = (away < best[who]) | ((away == best[who]) & (c < number[who]))
            best[who[better]], number[who[better]] = away[better], c
        frontier = np.minimum(gap(lo, vectors), gap(hi, vectors))
        walked = (frontier == _FAR).any(axis=1)  # a list at its end has shown every centroid
        least = (np.where(walked[:, None], 0, frontier) ** 2).sum(axis=1)
        active = active[~walked & (least <= best[active])]
    return number, best


def _assigned(centroids: np.ndarray, scale: int, dims: int):
    """(vec_id, cluster, distance) of every vector that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows, block = quantised(part.column("vec"), scale, dims)
                if len(rows):
                    number, away = nearest(block, centroids)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id").take(pa.array(rows)), pa.array(number, pa.int32()), pa.array(away)],
                        names=["vec_id", "cluster", "distance"])
    return run


def _sums(centroids: np.ndarray, scale: int, dims: int):
    """(cluster, dim, total, n) over a task's vectors; a cluster without vectors gives no row."""
    k = len(centroids)

    def rows_of(total: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        own = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(own)), pa.int32()),
             pa.array(total[own].reshape(-1)), pa.array(np.repeat(n[own], dims))], names=["cluster", "dim", "total", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                _, block = quantised(batch.column("vec").slice(at, BLOCK), scale, dims)
                if len(block):
                    number, _ = nearest(block, centroids)
                    np.add.at(total, number, block)
                    n += np.bincount(number, minlength=k)
            if n.sum() >= SUM_ROWS:
                yield rows_of(total, n)
                total[:], n[:] = 0, 0
        yield rows_of(total, n)
    return run


def _start(base: DataFrame, k: int, scale: int, dims: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids: k rows reach the driver."""
    valid = base.where(F.size("vec") == dims).where(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    scaled = F.transform("vec", lambda x: F.floor(F.lit(scale) * x))
    rows = valid.select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("h"), scaled.alias("c")).orderBy(
        F.asc_nulls_last("h"), "c").limit(k).collect()
    return np.array([row.c for row in rows], np.int64).reshape(len(rows), dims)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, dims: int = DIMS, salt: str = "1:") -> DataFrame:
    """One row per vector that counts: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid.

    ``distance`` is squared; inertias are its sums over the cluster and over all vectors.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    centroids = _start(base, k, scale, dims, salt)
    for _ in range(rounds if len(centroids) else 0):
        sums = base.mapInArrow(_sums(centroids, scale, dims), "cluster int, dim int, total long, n long").groupBy(
            "cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        centroids = centroids.copy()
        for row in sums.collect():  # k times dims rows
            centroids[row.cluster, row.dim] = int(row.total) // row.n
    assigned = base.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    if len(centroids):
        assigned = base.mapInArrow(_assigned(centroids, scale, dims), "vec_id long, cluster int, distance long")
    assigned = stored(assigned, "centroids-assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    described = [(int(row.cluster), int(row.s), int(sum(x.s for x in inertia)),
                  hashlib.sha256(",".join(map(str, centroids[row.cluster].tolist())).encode()).hexdigest(),
                  centroids[row.cluster].tolist()) for row in inertia]
    # one row for each of the k clusters
    known = spark.createDataFrame(described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, salt: str = "1:") -> str:
    """The query in SQL: every distance to every centroid, round by round."""
    steps = [f"""
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (SELECT r, unnest(range({dims})) AS d, unnest(v) AS x FROM vectors),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, v) - 1 AS c, v FROM vectors
  QUALIFY c < {k}
), k0 AS MATERIALIZED (SELECT c, unnest(range({dims})) AS d, unnest(v) AS x FROM c0)"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, c, s FROM (SELECT r, c, sum((cells.x - k{i}.x) * (cells.x - k{i}.x)) AS s FROM cells JOIN k{i} USING (d) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, c) = 1
)""")
        if i < rounds:
            steps.append(f"""
k{i + 1} AS MATERIALIZED (
  SELECT c, d, coalesce(CAST((t - ((t % n) + n) % n) // n AS BIGINT), k{i}.x) AS x FROM k{i} LEFT JOIN (
    SELECT c, d, sum(x) AS t, count(*) AS n FROM a{i} JOIN cells USING (r) GROUP BY c, d) USING (c, d)
)""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance,
  CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(s) OVER () AS BIGINT) AS inertia,
  sha256(t) AS centroid_sha256
FROM a{rounds} JOIN vectors USING (r)
JOIN (SELECT c, string_agg(CAST(x AS VARCHAR), ',' ORDER BY d) AS t FROM k{rounds} GROUP BY c) USING (c)
"""
