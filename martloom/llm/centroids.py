"""Centroid clustering in whole numbers; nearest centroids are found by Orchard search.

Every centroid has a list of all centroids by distance from it. A vector walks the list
of its closest centroid so far, jumps to the list of a closer one as soon as it meets
it, and stops where the list goes strictly beyond twice its own distance: by the triangle
inequality nothing from there on can be nearer, nor as near under a smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import arrow_schema
from .vectors import whole_vectors

SIZE, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
_ROWS = 1 << 13


def orchard(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to each vector's nearest centroid, ties to the smaller number."""
    n, k = len(vectors), len(centroids)
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    lists = np.argsort(apart, axis=1, kind="stable")
    at, place = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    best = ((vectors - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), dtype=bool)
    visited[:, 0] = True
    walking = np.arange(n)
    while len(walking):
        following = lists[at[walking], place[walking]]
        near = apart[at[walking], following] <= 4 * best[walking]
        walking, following = walking[near], following[near]
        place[walking] += 1
        new = ~visited[walking, following]
        met, centroid = walking[new], following[new]
        visited[met, centroid] = True
        distance = ((vectors[met] - centroids[centroid]) ** 2).sum(axis=1)
        better = (distance < best[met]) | ((distance == best[met]) & (centroid < at[met]))
        met = met[better]
        at[met], best[met], place[met] = centroid[better], distance[better], 0
        walking = walking[place[walking] < k]
    return at, best


def _pieces(batches: Iterator[pa.RecordBatch], size: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            rows, vectors = whole_vectors(part.column("embedding"), scale, size)
            if len(rows):
                yield part, rows, vectors


def first_centroids(vectors: DataFrame, k: int, size: int, scale: int, seed: int) -> np.ndarray:
    """The vectors whose sha256 of ``seed:vec_id`` is smallest, in its order; equal ones by components, null ids last."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = arrow_schema(f"vec_id {kind}, vector array<bigint>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers, whole in _pieces(batches, size, scale):
            lists = pa.ListArray.from_arrays(np.arange(len(whole) + 1, dtype=np.int32) * size, pa.array(whole.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id").take(pa.array(numbers)), lists.cast(schema.field(1).type)], schema=schema)

    kept = vectors.select("vec_id", "embedding").mapInArrow(rows, f"vec_id {kind}, vector array<bigint>")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(digest.asc_nulls_last(), "vector").limit(k)
    return np.array([row.vector for row in first.select("vector").collect()], dtype=np.int64).reshape(-1, size)


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: each centroid becomes the floored mean of its vectors; one without any stays."""
    k, size = centroids.shape
    schema = arrow_schema("cluster int, place int, total long, n long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, size), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, _, whole in _pieces(batches, size, scale):
            cluster, _ = orchard(whole, centroids)
            np.add.at(totals, cluster, whole)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        columns = (np.repeat(some, size), np.tile(np.arange(size), len(some)), totals[some].ravel(), np.repeat(counts[some], size))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    sums = vectors.select("embedding").mapInArrow(rows, "cluster int, place int, total long, n long")
    new = centroids.copy()
    for row in sums.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[row.cluster, row.place] = row.total // row.n
    return new


def clusters(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per usable vector of ``vectors``.

    Vectors that are null, of another size, or hold a null or non-finite component get no row.
    Repeated rows are vectors of their own. Null ids are kept and start no centroid while others can. Fewer
    vectors than ``k`` make fewer centroids, none an empty result. What reaches the driver is ``k`` times
    ``size`` sums a round, which don't grow with the vectors. No round keeps anything on executors; a round
    that changes nothing is the last, as those after it would be the same.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, cluster int, distance long"
    schema = arrow_schema(out)
    centroids = first_centroids(vectors, k, size, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, moved(vectors, centroids, scale)
        if (before == centroids).all():
            break

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers, whole in _pieces(batches, size, scale):
            cluster, distance = orchard(whole, centroids)
            ids = part.column("vec_id").take(pa.array(numbers))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], schema=schema)

    assigned = vectors.select("vec_id", "embedding").mapInArrow(rows, out)
    sums = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame(
        [(c, total, sum(sums.values()), digests[c]) for c, total in sums.items()],
        "about int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(about, assigned["cluster"] == about["about"]).drop("about")
