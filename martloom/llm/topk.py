"""Exact top-k inner products by no-random-access aggregation.

Queries are dealt into blocks and candidates into shards; a task joins one block with
one shard. It sorts a piece of its candidates into one list per component and reads all
lists from their ends, stretch by stretch: from the top for a query's positive
components, from the bottom for its negative ones. What has been read gives every
candidate a lower and an upper bound of its score - a component not yet read lies
between the list's place and its far end. A query stops reading once few enough
candidates can still reach its k-th lower bound; those left get their final scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import arrow_schema
from .vectors import whole_vectors

K, SCALE = 5, 256
#: Queries of a block, candidates of a shard, and candidates of whose components lists are sorted at once.
BLOCK, SHARD, PIECE = 1 << 13, 1 << 16, 1 << 12
#: Shares of a list after which bounds are compared.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 1 / 2)
#: A query reads on while more candidates than this can qualify.
LEFT = 24
_QUERIES = 256


class Lists:
    """Lists of the components of some candidates, sorted in descending order, and what has been read of them."""

    def __init__(self, vectors: np.ndarray):
        self.values = vectors
        self.order = np.argsort(-vectors, axis=0, kind="stable")
        self.high, self.low = vectors.max(axis=0), vectors.min(axis=0)
        self.read = 0
        self.from_top = np.zeros(vectors.shape, dtype=bool)
        self.from_bottom = np.zeros(vectors.shape, dtype=bool)

    def read_to(self, depth: int) -> None:
        """Read on from both ends of every list, up to ``depth`` entries from each."""
        columns = np.arange(self.values.shape[1])
        n = len(self.values)
        self.from_top[self.order[self.read : depth], columns] = True
        self.from_bottom[self.order[n - depth : n - self.read], columns] = True
        self.read = depth

    def bounds(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Components to multiply by a query's positive and negative ones: for lower, then for upper bounds."""
        columns, n = np.arange(self.values.shape[1]), len(self.values)
        last_top = self.values[self.order[self.read - 1], columns]
        last_bottom = self.values[self.order[n - self.read], columns]
        top, bottom = self.from_top, self.from_bottom
        lower = np.where(top, self.values, self.low), np.where(bottom, self.values, self.high)
        upper = np.where(top, self.values, last_top), np.where(bottom, self.values, last_bottom)
        return lower, upper


class Best:
    """The k best of each query so far: scores, ids (null ids last) and marks that tell rows of one id apart."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, marks: np.ndarray, k: int):
        self.queries, self.ids, self.marks, self.k = queries, ids, marks, k
        self.plus, self.minus = np.maximum(queries, 0), np.minimum(queries, 0)
        self.found = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))  # query, -score, id is null, id, mark

    def floor(self) -> np.ndarray:
        """Each query's k-th score so far; where there are fewer, nothing is too low."""
        owner, score = self.found[0], -self.found[1]
        floor = np.full(len(self.ids), -(1 << 62))
        full = np.bincount(owner, minlength=len(self.ids)) == self.k
        np.minimum.at(least := np.full(len(self.ids), 1 << 62), owner, score)
        floor[full] = least[full]
        return floor

    def add(self, owner: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.found, (owner, -score, null, ids, marks))]
        order = np.lexsort(rows[::-1])
        rows = [x[order] for x in rows]
        again = np.zeros(len(order), dtype=bool)
        again[1:] = np.logical_and.reduce([x[1:] == x[:-1] for x in rows])
        rows = [x[~again] for x in rows]
        starts = np.searchsorted(rows[0], rows[0])
        keep = np.arange(len(rows[0])) - starts < self.k
        self.found = tuple(x[keep] for x in rows)


def _product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of all rows of a and b, in doubles where these hold every sum exactly."""
    return a.astype(np.float64) @ b.astype(np.float64).T if exact else a @ b.T


def search(best: Best, vectors: np.ndarray, null: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
    """Take some candidates into account."""
    most = np.abs(vectors).max(initial=0) * int(np.abs(best.queries).sum(axis=1).max(initial=0))
    if int(most) >= 1 << 62:
        raise ValueError("a score may leave 64 bits")
    exact = int(most) < 1 << 52
    _, first = np.unique(np.stack([null, ids, marks]), axis=1, return_index=True)
    vectors, null, ids, marks = vectors[first], null[first], ids[first], marks[first]
    lists, n = Lists(vectors), len(vectors)
    floor, reading = best.floor(), np.arange(len(best.ids))
    for share in (*DEPTHS, 1):
        if not len(reading):
            break
        lists.read_to(max(1, min(n, int(np.ceil(n * share)))))
        lower, upper = lists.bounds()
        go_on = []
        for some in np.array_split(reading, -(-len(reading) // _QUERIES)):
            plus, minus = best.plus[some], best.minus[some]
            low = _product(plus, lower[0], exact) + _product(minus, lower[1], exact)
            high = _product(plus, upper[0], exact) + _product(minus, upper[1], exact)
            own = (best.ids[some][:, None] == ids[None, :]) & (null == 0)
            low[own] = -(1 << 62)
            kth = np.partition(low, n - best.k, axis=1)[:, n - best.k] if n >= best.k else np.full(len(some), -(1 << 62))
            qualify = (high >= np.maximum(kth, floor[some])[:, None]) & ~own
            done = (qualify.sum(axis=1) <= LEFT) | (share == 1)
            row, column = np.nonzero(qualify & done[:, None])
            score = (best.queries[some[row]] * vectors[column]).sum(axis=1)
            best.add(some[row], score, null[column], ids[column], marks[column])
            go_on.append(some[~done])
        reading = np.concatenate(go_on)


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def _task_rows(k: int, schema: pa.Schema):
    """Rows come by task number, queries before candidates."""

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return whole_vectors(batch.column("vector"), 1)[1]

    def lanes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = batch.column("vec_id")
        return np.asarray(ids.is_null()).astype(np.int64), np.asarray(ids.fill_null(0)), np.asarray(batch.column("mark"))

    def result(best: Best) -> pa.RecordBatch:
        owner, score, null, ids, marks = best.found
        columns = [pa.array(best.ids[owner]), pa.array(best.marks[owner]), pa.array(-score), pa.array(ids, mask=null == 1), pa.array(marks)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[pa.RecordBatch] = []
        task, best = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE):
                piece = batch.slice(start, PIECE)
                kinds = np.asarray(piece.column("task")) * 2 + np.asarray(piece.column("side"))
                cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
                for a, b in zip(cuts, cuts[1:]):
                    part = piece.slice(a, b - a)
                    if kinds[a] // 2 != task:
                        if best is not None:
                            yield result(best)
                        task, best, asked = kinds[a] // 2, None, []
                    if kinds[a] % 2 == 0:
                        asked.append(part)
                    elif asked:
                        if best is None:
                            matrices = [matrix(q) for q in asked]
                            width = max(m.shape[1] for m in matrices)
                            _, ids, marks = map(np.concatenate, zip(*map(lanes, asked)))
                            best = Best(np.concatenate([_padded(m, width) for m in matrices]), ids, marks, k)
                        vectors = matrix(part)
                        width = max(vectors.shape[1], best.queries.shape[1])
                        if best.queries.shape[1] < width:
                            best.queries, best.plus, best.minus = (_padded(x, width) for x in (best.queries, best.plus, best.minus))
                        search(best, _padded(vectors, width), *lanes(part))
        if best is not None:
            yield result(best)

    return rows


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, vector, mark): usable vectors in whole numbers and a hash of them."""
    schema = arrow_schema("vec_id bigint, vector array<bigint>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, whole = whole_vectors(batch.column("embedding"), scale)
            lengths = np.asarray(batch.column("embedding").take(pa.array(numbers)).value_lengths())
            flat = whole[np.arange(whole.shape[1]) < lengths[:, None]]
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat)).cast(schema.field(1).type)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(numbers)), lists], schema=schema)

    found = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(rows, "vec_id bigint, vector array<bigint>")
    return found.withColumn("mark", F.xxhash64("vector"))


def top_inner_products(queries: DataFrame, vectors: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` greatest inner products of each query with vectors of another id.

    Both tables have vec_id and embedding. Components count as floor(scale * x); vectors that are null or hold a
    null or non-finite component take no part, and of two lengths the shorter is filled up with zeros.
    Ties go to the smaller id, null ids last. Rows equal in id and vector are one. Queries without an id
    ask nothing; rows of one id and different vectors are queries and candidates of their own. An
    empty table gives an empty result. A task holds a block of queries and a piece of its shard.
    """
    spark = vectors.sparkSession
    asked = _whole(queries.where(F.col("vec_id").isNotNull()), scale).distinct()
    n_asked, n = queries.count(), vectors.count()
    blocks = max(1, -(-n_asked // BLOCK))
    shards = max(1, -(-n // SHARD), min(spark.sparkContext.defaultParallelism, -(-n // 1024)))
    spread = F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks))
    parts = [
        asked.select("*", spread.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(0).alias("side")),
        _whole(vectors, scale).select(
            "*",
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"),
            F.lit(1).alias("side"),
        ),
    ]
    task = (F.col("block") * shards + F.col("shard")).cast("int")
    dealt = parts[0].unionByName(parts[1]).select(task.alias("task"), "side", "vec_id", "vector", "mark")
    out = "query_id bigint, query_mark bigint, score bigint, vec_id bigint, mark bigint"
    found = (
        dealt.repartitionById(blocks * shards, "task")
        .sortWithinPartitions("task", "side")
        .mapInArrow(_task_rows(k, arrow_schema(out)), out)
    )
    order = Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "mark")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
