"""Latest record, top-k and current/previous per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(*names: str) -> list[Column]:
    """Descending sort keys with NULL last, stated so that every engine agrees."""
    return [F.col(n).desc_nulls_last() for n in names]


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str = "rn") -> DataFrame:
    """Number the rows of every key. ``order`` must end in a unique tie-break.

    The window holds a whole key in one task, so use it on aggregated rows whose
    number per key is bounded (regions, recharge sources), and ``top_k`` on raw rows.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn"
) -> DataFrame:
    """The first ``k`` rows per key, with their rank.

    ``rank <= k`` lets Catalyst put a WindowGroupLimit below the exchange: each
    task sends at most ``k`` rows of a key, however many rows a hot key has.
    """
    return ranked(df, keys, order, rank).filter(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_rank").drop("_rank")


def current_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    current: dict[str, str],
    previous: dict[str, str],
) -> DataFrame:
    """One row per key from its two newest rows: ``{output: source column}`` of each.

    The aggregation groups by the window's own keys and needs no further exchange.
    """
    newest_two = top_k(df, keys, order, 2, "_rank")

    def at(rank: int, source: str) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(source)))

    return newest_two.groupBy(*keys).agg(
        *[at(1, source).alias(name) for name, source in current.items()],
        *[at(2, source).alias(name) for name, source in previous.items()],
    )
