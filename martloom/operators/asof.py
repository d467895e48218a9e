"""The latest earlier record of the same key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.joins import unique_lookup


def prior_record(
    records: DataFrame,
    key: str,
    order: str,
    payload: Mapping[str, str],
    block: int = 1 << 20,
) -> DataFrame:
    """For every record the one with the next smaller ``order`` of the same ``key``.

    Equals a self join on ``key`` with ``t.order > b.order`` that keeps the greatest
    ``b.order``, without its quadratic output. ``order`` must be a unique integer.
    ``payload`` maps output names to columns of the earlier record; returns
    ``order`` and the outputs, NULL for the first record of a key and for NULL keys.

    A plain ``lag`` over ``key`` would sort a hot key in one task, so the order axis
    is cut into blocks of ``block`` values. Inside (key, block) - at most ``block``
    rows, as ``order`` is unique - ``lag`` answers every row but the first. The first
    row takes the last record of the key's previous non-empty block, which is the same
    question asked of one row per block, and is answered the same way with blocks of
    blocks. Whatever the number of a key's records, a window holds at most ``block`` of
    them, and the last one a row for every 2**40 order values.
    """
    if block < 2:
        raise ValueError("a block holds at least two values")
    columns = {name: F.col(source) for name, source in payload.items()}
    named = records.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(order).cast("bigint").alias("_order"),
        F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_row"),
    )
    kind = records.schema[order].dataType
    return _with_previous(named, block).select(
        F.col("_order").cast(kind).alias(order), *[F.col("_prior")[n].alias(n) for n in columns]
    )


#: Blocks this wide are few enough to be one window: 2**24 for all 64-bit order values.
_WIDE = 1 << 40


def _with_previous(rows: DataFrame, block: int, width: int = 1) -> DataFrame:
    """``rows`` (_key, _order, _row) with _prior: the row of the key's next smaller _order.

    The _order values are multiples of ``width``.
    """
    span = width * block
    in_key = Window.partitionBy("_key").orderBy("_order")
    if width >= _WIDE:
        return rows.select("_key", "_order", F.lag("_row").over(in_key).alias("_prior"))
    # Rows that arrive partitioned by the key alone would satisfy the window below as they
    # are and leave a hot key in one task, so the exchange by block is explicit. The rows
    # and their blocks' last rows both come from it.
    start = (F.col("_order") - F.pmod(F.col("_order"), F.lit(span))).alias("_block")
    blocks = rows.select("_key", "_order", "_row", start).repartition("_key", "_block")
    in_block = Window.partitionBy("_key", "_block").orderBy("_order")
    local = blocks.select(
        "_key",
        "_block",
        "_order",
        F.lag("_row").over(in_block).alias("_near"),
        F.row_number().over(in_block).alias("_place"),
    )
    lasts = blocks.groupBy("_key", "_block").agg(F.max_by("_row", "_order").alias("_row"))
    carried = _with_previous(lasts.withColumnRenamed("_block", "_order"), block, span).select(
        F.col("_key").alias("_carry_key"), F.col("_order").alias("_carry_block"), F.col("_prior").alias("_far")
    )
    head = (F.col("_place") == 1) & (F.col("_key") == F.col("_carry_key")) & (F.col("_block") == F.col("_carry_block"))
    prior = F.when(F.col("_place") == 1, F.col("_far")).otherwise(F.col("_near")).alias("_prior")
    return local.join(carried, head, "left").select("_key", "_order", prior)


def with_prior(
    left: DataFrame,
    records: DataFrame,
    key: str,
    order: str,
    payload: Mapping[str, str],
    block: int = 1 << 20,
) -> DataFrame:
    """Left rows that refer to records by ``order``, with each record's predecessor.

    Where the left side has ``key``, only records of keys that occur there are put in order:
    a semi join with its different keys comes before the blocks and their windows. The left
    side is then used twice; exchanges that both uses have in common are run once.
    """
    if key in left.columns:
        wanted = unique_lookup(left.select(F.col(key).alias("_wanted")), ["_wanted"])
        records = records.join(wanted, records[key] == wanted["_wanted"], "left_semi")
    return left.join(prior_record(records, key, order, payload, block), order, "left")
