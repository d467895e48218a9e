"""Words of texts, in Spark expressions and in Python tasks, and small task helpers."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martloom.sinks.folders import fresh_folder

#: A normalised word: digits, a-z and everything outside ASCII.
NORMAL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bytes of text that a Python task handles at once.
PIECE_BYTES = 8 << 20

#: Rows in an Arrow batch that a Python task hands back.
OUT_ROWS = 1 << 16


def normal_words(text: Column) -> Column:
    """The normalised words of a text, A-Z lower-cased; null has none."""
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.regexp_extract_all(lowered, F.lit(NORMAL_WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(text)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows in the folder that ``spark.checkpoint.dir`` names, their lineage cut.

    Where the session names none, they go to a folder of the process's own below the warehouse.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(fresh_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def id_type(docs: DataFrame, column: str = "doc_id") -> str:
    return docs.schema[column].dataType.simpleString()


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a schema given as text; needs a session."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def per_document(docs: DataFrame, columns: str, result: Callable[[str], tuple]) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``result`` of its text, null as empty."""
    schema = f"doc_id {id_type(docs)}, {columns}"
    arrow = arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [result(text or "") for text in batch.column("text").to_pylist()]
            arrays = [batch.column("doc_id").cast(arrow.field(0).type)]
            for i in range(1, len(arrow)):
                arrays.append(pa.array([row[i - 1] for row in found], arrow.field(i).type))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, sample: int, budget: int) -> DataFrame:
    """doc_id, ``label`` and text of at most ``sample`` ids of each label 0 and 1, those of the smallest id hash.

    What a model on the driver is fitted on: at most ``budget`` characters together. Of several texts of one id
    the one of the least hash is taken, once; ids whose text doesn't fit into what is left are passed over.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.col("doc_id").cast("string"))
    usable = labels.where(F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias(label))
    picked = [usable.where(F.col(label) == value).orderBy(order, "doc_id").limit(sample) for value in (0, 1)]
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    known = texts.join(F.broadcast(picked[0].unionByName(picked[1]).distinct()), "doc_id")
    sizes = known.groupBy("doc_id", label).agg(F.min(F.struct("text_hash", F.length(F.coalesce("text", F.lit(""))).alias("size"))).alias("least"))
    found = sizes.select("doc_id", label, "least.text_hash", "least.size", order.alias("place")).collect()
    wanted, left = [], budget
    for row in sorted(found, key=lambda r: (r["place"], r["doc_id"], r[label])):
        if row["size"] <= left:
            left -= row["size"]
            wanted.append((row["doc_id"], row[label], row["text_hash"]))
    chosen = spark.createDataFrame(wanted, f"doc_id {id_type(docs)}, {label} int, text_hash long")
    return texts.join(F.broadcast(chosen), ["doc_id", "text_hash"]).groupBy("doc_id", label).agg(F.any_value("text").alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of some ``PIECE_BYTES`` or of one row; ``column`` holds texts or their sizes."""
    for batch in batches:
        lengths = batch.column(column)
        if not pa.types.is_integer(lengths.type):
            lengths = pc.fill_null(pc.binary_length(lengths), 0)
        part = np.cumsum(np.asarray(lengths, dtype=np.int64)) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def handed_back(arrays: list, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns as Arrow batches of at most ``OUT_ROWS`` rows."""
    table = pa.Table.from_arrays(arrays, schema=schema)
    yield from table.to_batches(max_chunksize=OUT_ROWS)
