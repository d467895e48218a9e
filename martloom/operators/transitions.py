"""Moments at which an order reached one of the wanted statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_transitions(
    current: DataFrame,
    current_reached: Column,
    current_columns: Sequence[str],
    log: DataFrame,
    log_reached: Column,
    log_columns: Sequence[str],
) -> DataFrame:
    """Current states and logged states as one ``id, status, status_date`` list.

    ``*_columns`` name the id, status and date columns of each side. UNION ALL:
    a state that is both current and logged, or logged twice, appears twice.
    Both filters are on bare columns and reach the scans.
    """
    names = ("id", "status", "status_date")

    def side(df: DataFrame, reached: Column, columns: Sequence[str]) -> DataFrame:
        return df.filter(reached).select(*[F.col(c).alias(n) for c, n in zip(columns, names)])

    return side(current, current_reached, current_columns).unionByName(
        side(log, log_reached, log_columns)
    )


def one_per_moment(transitions: DataFrame) -> DataFrame:
    """One row per id and moment; of several statuses the greatest code stays.

    An aggregate rather than a row number: repeats collapse before the exchange.
    """
    return transitions.groupBy("id", "status_date").agg(F.max("status").alias("status"))
