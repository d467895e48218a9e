"""Many conditional aggregates over few shared conditions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Metric:
    """``how`` the ``value`` of the rows on which all ``when`` flags hold is combined.

    ``total``, ``count`` and ``peak`` give 0 when no row qualifies, ``latest`` NULL.
    """

    name: str
    how: str
    value: str | None
    when: tuple[str, ...]


def bit_positions(metrics: Sequence[Metric]) -> dict[str, int]:
    """The bit each flag of the metrics is kept in."""
    used = sorted({flag for m in metrics for flag in m.when})
    if len(used) > 62:
        raise ValueError("at most 62 flags fit one bit mask")
    return {name: 1 << i for i, name in enumerate(used)}


def pack(flags: Mapping[str, Column], bits: Mapping[str, int]) -> Column:
    """The flags that hold as one long; an unknown (NULL) flag does not hold."""
    packed = F.lit(0).cast("bigint")
    for name, holds in flags.items():
        if name in bits:
            bit = F.lit(bits[name]).cast("bigint")
            packed = packed.bitwiseOR(F.when(holds, bit).otherwise(F.lit(0).cast("bigint")))
    return packed


def aggregate_packed(
    rows: DataFrame,
    keys: Sequence[str],
    packed: str,
    bits: Mapping[str, int],
    metrics: Sequence[Metric],
    finish: Mapping[str, Callable[[Column], Column]] | None = None,
    few_rows_per_key: bool = False,
) -> DataFrame:
    """One row per key with all metrics, in one aggregation and one exchange.

    A metric's condition is one mask test on the ``packed`` column whatever the number
    of its flags, which keeps the generated code of a wide aggregate small enough to
    be compiled. The exchanged buffers hold all metrics, but most are 0 and take little
    room compressed: combining per key and flags first and exchanging those narrower
    a function of its aggregate (a unit conversion done once per group).

    With ``few_rows_per_key`` the narrow rows themselves are exchanged once and sorted by
    key, and one buffer at a time is filled (``tune`` lets Spark aggregate what is sorted
    in order). Combining before the exchange gains little then, and both sides of it
    would hold a wide buffer of every key. All rows of a key are read by one task.
    """
    finish = finish or {}

    def holds(metric: Metric) -> Column:
        mask = F.lit(sum(bits[f] for f in metric.when)).cast("bigint")
        return F.col(packed).bitwiseAND(mask) == mask

    def combine(metric: Metric) -> Column:
        if metric.how == "count":
            out = F.count_if(holds(metric))
        elif metric.how == "total":
            out = F.sum(F.when(holds(metric), F.col(metric.value)).otherwise(0))
        elif metric.how == "peak":
            out = F.max(F.when(holds(metric), F.col(metric.value)).otherwise(0))
        elif metric.how == "latest":
            out = F.max(F.when(holds(metric), F.col(metric.value)))
        else:
            raise ValueError(f"unknown aggregate {metric.how!r}")
        return finish.get(metric.value, lambda c: c)(out).alias(metric.name)

    combined = [combine(m) for m in metrics]
    if not few_rows_per_key:
        return rows.groupBy(*keys).agg(*combined)
    # No metric depends on the order of the rows, so the optimizer would drop the sort; an
    # any_value, here of a key, makes it stay.
    in_order = rows.repartition(*keys).sortWithinPartitions(*keys)
    found = in_order.groupBy(*keys).agg(F.any_value(keys[-1]).alias("_last_key"), *combined)
    return found.select(*keys[:-1], F.col("_last_key").alias(keys[-1]), *[m.name for m in metrics])


def conditional_metrics(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, Column],
    values: Mapping[str, Column],
    metrics: Sequence[Metric],
    finish: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """``aggregate_packed`` on flags and values that are all columns of ``df``."""
    bits = bit_positions(metrics)
    needed = sorted({m.value for m in metrics if m.value})
    rows = df.select(*keys, pack(flags, bits).alias("_flags"), *[values[v].alias(v) for v in needed])
    return aggregate_packed(rows, keys, "_flags", bits, metrics, finish)


@dataclass(frozen=True)
class Amount:
    """A numeric column in the form that adds up exactly: ``units`` of 10**-``scale``."""

    units: Column
    scale: int

    def total(self, units: Column) -> Column:
        """A sum (or peak) of units as an amount; its fraction has the column's own digits.

        Most sums of a wide aggregate are 0, which needs no decimal arithmetic.
        """
        if not self.scale:
            return units
        kind = f"decimal(28,{self.scale})"
        return F.when(units == 0, F.lit(0).cast(kind)).otherwise(self._scaled(units).cast(kind))

    def per(self, units: Column, parts: int) -> Column:
        """A sum of units in another unit of measure, divided once."""
        amount = self._scaled(units) if self.scale else units
        return F.when(units == 0, F.lit(0.0)).otherwise(amount.cast("double") / parts)

    def _scaled(self, units: Column) -> Column:
        return units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-self.scale))


def exact(df: DataFrame, column: Column) -> Amount:
    """``column`` of ``df`` for summing without loss, whatever its numeric type.

    Whole numbers and decimals of up to four digits after the point become longs, whose
    sums stay in the fixed-width fast path of the hash aggregate and raise on overflow
    under ANSI mode. Decimals of more digits are summed as they are. Floating-point
    input, which has no exact decimal form, is rounded to a millionth once.
    """
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, T.DecimalType) and kind.scale <= 4:
        return Amount((column * 10**kind.scale).cast("bigint"), kind.scale)
    if isinstance(kind, T.IntegralType):
        return Amount(column.cast("bigint"), 0)
    return Amount(column if isinstance(kind, T.DecimalType) else column.cast("decimal(28,6)"), 0)
