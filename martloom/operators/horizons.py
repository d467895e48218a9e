"""Several trailing windows from one scan, with exact distinct days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 63


def day_marks(age: Column, span: int) -> list[Column]:
    """Aggregates that remember which of ``span`` days a group was seen on.

    ``age`` is the day's distance from the window's end, 0 for the newest day. Each
    aggregate is the OR of one bit per day in a long: unlike ``count_distinct`` it
    is exact with a single exchange and combines fully before it, since the state
    is a fixed number of longs whatever the number of rows.
    """
    marks = []
    for word in range(-(-span // _BITS)):
        low = word * _BITS
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (age - low).cast("int"))
        inside = (age >= low) & (age < low + _BITS)
        marks.append(F.bit_or(F.when(inside, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_days{word}"))
    return marks


def days_seen(span: int, newest: int) -> Column:
    """How many of the ``newest`` days a group was seen on, from ``day_marks(age, span)``."""
    total = F.lit(0).cast("bigint")
    for word in range(-(-span // _BITS)):
        width = max(0, min(_BITS, newest - word * _BITS))
        if width:
            mask = F.lit((1 << width) - 1).cast("bigint")
            total = total + F.bit_count(F.col(f"_days{word}").bitwiseAND(mask)).cast("bigint")
    return total


def sum_within(age: Column, days: int, value: Column) -> Column:
    """Sum over the newest ``days`` days of a wider scan; 0 if a group has none."""
    return F.sum(F.when(age < days, value).otherwise(F.lit(0).cast("bigint")))


def unpivot_horizons(horizons: Sequence[int], columns: Sequence[str], column_at) -> Column:
    """One array of structs, an entry per horizon, for ``explode``."""
    return F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), *[column_at(h, c).alias(c) for c in columns])
            for h in horizons
        ]
    )
