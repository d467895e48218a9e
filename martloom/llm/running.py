"""Running sums over keys of any size.

A window over a key would put all its rows in one task. Here rows are sorted by ranges of
(key, order), so that a hot key lies in several neighbouring partitions; each partition
sums its own rows, and what its first key has had before is added afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.sinks.folders import materialise

from .text import arrow_schema

_FIRST, _LAST = 1, 2


def _within(key: np.ndarray, values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Inclusive sums of each key's run; ``before`` goes to the first run. All wrap at 64 bits."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sums = np.cumsum(values, axis=1)
    base = sums[:, starts] - values[:, starts]
    base[:, 0] -= before
    return sums - np.repeat(base, np.diff(np.append(starts, len(key))), axis=1)


def _local_rows(key: str, values: list[str], schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before, waiting = TaskContext.get().partitionId(), None, np.zeros(len(values), dtype=np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                yield waiting
            keys = np.asarray(batch.column(key))
            own = np.stack([np.asarray(batch.column(v)) for v in values])
            sums = _within(keys, own, before if keys[0] == last else 0)
            edge = np.zeros(len(keys), dtype=np.int32)
            edge[0] = _FIRST if waiting is None else 0
            last, before = keys[-1], sums[:, -1]
            arrays = [*batch.columns, *map(pa.array, sums), pa.array(np.full(len(keys), part, dtype=np.int32)), pa.array(edge)]
            waiting = pa.RecordBatch.from_arrays(arrays, schema=schema)
        if waiting is not None:
            edge = np.array(waiting.column("edge"))
            edge[-1] |= _LAST
            yield waiting.set_column(waiting.num_columns - 1, schema.field("edge"), pa.array(edge))

    return rows


def _carried(edges: list, values: list[str]) -> dict[int, tuple[int, np.ndarray]]:
    """For each partition that begins inside a key: that key and its sums before the partition."""
    found, last, sums = {}, None, None
    parts: dict[int, dict[int, tuple]] = {}
    for row in edges:
        for mark in (_FIRST, _LAST):
            if row["edge"] & mark:
                parts.setdefault(row["part"], {})[mark] = (row["key"], np.array([row[v] for v in values], dtype=np.int64))
    for part in sorted(parts):
        (first, _), (end, total) = parts[part][_FIRST], parts[part][_LAST]
        if first == last:
            found[part] = first, sums
            total = total + sums if end == first else total
        last, sums = end, total
    return found


def running_sums(df: DataFrame, key: str, order: list[Column], values: dict[str, str], name: str) -> DataFrame:
    """``df`` and, for each ``{column: sum column}``, its sum over the key's rows up to the row; sums wrap at 64 bits.

    ``key`` and the columns are longs without nulls; ``order`` should be unique in a key. Rows are
    written once, below the shared folder. The driver gets two rows of sums a partition.
    """
    sums = list(values.values())
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    local = given + "".join(f", {s} long" for s in sums) + ", part int, edge int"
    sorted_rows = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    marked = materialise(sorted_rows.mapInArrow(_local_rows(key, list(values), arrow_schema(local)), local), name)
    edges = marked.where("edge > 0").select(F.col(key).alias("key"), "part", "edge", *sums).collect()
    before = _carried(edges, sums)
    if not before:
        return marked.drop("part", "edge")
    out = given + "".join(f", {s} long" for s in sums)
    schema = arrow_schema(out)

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = np.asarray(batch.column(key)), np.asarray(batch.column("part"))
            columns = {s: np.array(batch.column(s)) for s in sums}
            for part in np.unique(parts).tolist():
                if part in before:
                    first, more = before[part]
                    here = (parts == part) & (keys == first)
                    for s, extra in zip(sums, more):
                        columns[s][here] += extra
            arrays = [pa.array(columns[f.name]) if f.name in columns else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return marked.mapInArrow(shifted, out)
