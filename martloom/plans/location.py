"""Hourly usage, usage by region, region ranking and primary region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.classify import equivalent_rate, home_network
from martloom.functions.dates import as_date, day_literal, days_ago, trailing
from martloom.functions.text import clean_id
from martloom.operators.horizons import day_marks, days_seen, sum_within, unpivot_horizons
from martloom.operators.joins import unique_lookup
from martloom.operators.kpi import Amount, exact
from martloom.operators.ranking import newest, ranked

SUBSCRIBER = ["subs_key", "ban_key"]
HORIZONS = (7, 30, 90)
_MEGABYTE = 1048576


def billable_home_traffic() -> Column:
    """Counted or charged, not forwarded, voice or data, on the home network."""
    return (
        ((F.col("counted_cdr_ind") == "1") | (F.col("charge_amt") != 0))
        & (F.col("call_forward_ind") != 1)
        & F.col("call_type_code").isin("V", "G")
        & home_network(F.col("roaming_ind"), F.col("roaming_type_key"))
    )


def usage_hourly(det_layer: DataFrame) -> DataFrame:
    """Calls, minutes and megabytes per day, hour, subscriber, account and cell.

    Seconds and bytes are summed exactly, whatever their numeric type, and divided once
    per group, so the result does not depend on the order in which tasks add up. The
    undivided sums are columns too; later sums start from them. Identifiers of over 18
    digits are no numbers here: such a cell is NULL.
    """
    seconds = exact(det_layer, F.col("actual_call_duration_sec"))
    volume = exact(det_layer, F.col("rounded_data_volume"))

    def voice(direction: str) -> Column:
        return (F.col("call_type_code") == "V") & (F.col("call_direction_ind") == direction)

    def total(condition: Column, amount: Amount) -> Column:
        return F.sum(F.when(condition, amount.units).otherwise(F.lit(0)))

    out, into = total(voice("2"), seconds), total(voice("1"), seconds)
    transferred = total(F.col("call_type_code") == "G", volume)
    return (
        det_layer.filter(billable_home_traffic())
        .groupBy(
            F.to_date("call_start_time").alias("period"),
            F.date_format("call_start_time", "HH").alias("hhour_id"),
            *SUBSCRIBER,
            clean_id(F.col("lac")).alias("lac"),
            clean_id(F.col("cell_id")).alias("cell_id"),
        )
        .agg(
            F.count_if(voice("2")).alias("call_out_amt"),
            F.count_if(voice("1")).alias("call_in_amt"),
            seconds.per(out, 60).alias("call_out_duration_min"),
            seconds.per(into, 60).alias("call_in_duration_min"),
            volume.per(transferred, _MEGABYTE).alias("data_vlm_mb"),
            seconds.total(out).alias("call_out_sec"),
            seconds.total(into).alias("call_in_sec"),
            volume.total(transferred).alias("data_bytes"),
        )
    )


# Counters of one usage row, by the hourly mart's columns.
_COUNTERS = {
    "_out": "call_out_amt",
    "_in": "call_in_amt",
    "_out_sec": "call_out_sec",
    "_in_sec": "call_in_sec",
    "_bytes": "data_bytes",
}
_TOTALS = (*_COUNTERS, "_voice_low", "_voice_high", "_bytes_known")


def _wide_region_usage(
    usage: DataFrame,
    cells: DataFrame,
    as_of: date | str,
    horizons: Sequence[int],
    amounts: Mapping[str, Amount],
) -> DataFrame:
    """One row per subscriber, account and region with every horizon's exact totals."""
    span = max(horizons)
    recent = usage.filter(trailing(F.col("period"), as_of, span)).select(
        *SUBSCRIBER,
        "period",
        F.col("lac").cast("bigint").alias("lac"),
        F.col("cell_id").cast("bigint").alias("cell_id"),
        *[amounts[n].units.alias(n) for n in _COUNTERS],
    )
    placed = recent.join(
        unique_lookup(cells, ["lac", "cell_id"], "region", "cell_nettype"), ["lac", "cell_id"], "left"
    )
    # Seconds by the rate they are weighted with; equivalent_rate is the one rule.
    rate = equivalent_rate(F.col("cell_nettype"))
    spoken = F.col("_out_sec") + F.col("_in_sec")
    zero = F.lit(0)
    rows = placed.select(
        *SUBSCRIBER,
        "region",
        (days_ago(F.col("period"), as_of) - 1).alias("_age"),
        *_COUNTERS,
        F.when(rate == 20.0, spoken).otherwise(zero).alias("_voice_low"),
        F.when(rate == 21.4, spoken).otherwise(zero).alias("_voice_high"),
        F.when(rate.isNotNull(), F.col("_bytes")).otherwise(zero).alias("_bytes_known"),
        F.when(rate.isNotNull(), F.lit(1)).otherwise(zero).cast("bigint").alias("_known"),
    )
    age = F.col("_age")
    return rows.groupBy(*SUBSCRIBER, "region").agg(
        *day_marks(age, span),
        *[
            (F.sum(c) if h == span else sum_within(age, h, F.col(c))).alias(f"{c}@{h}")
            for h in horizons
            for c in (*_TOTALS, "_known")
        ],
    )


def usage_by_region(
    usage: DataFrame, cells: DataFrame, as_of: date | str, horizons: Sequence[int] = HORIZONS
) -> DataFrame:
    """Usage per subscriber, account and region over trailing windows, one row per horizon.

    ``usage`` is the hourly mart's output, ``cells`` the cell-site dimension; a cell
    it does not know gives region NULL. All horizons come from one scan of the
    longest one.
    """
    as_of = as_date(as_of)
    span = max(horizons)
    amounts = {n: exact(usage, F.col(c)) for n, c in _COUNTERS.items()}
    wide = _wide_region_usage(usage, cells, as_of, horizons, amounts)
    names = ("uniq_days_amt", *_TOTALS, "_known")

    def at(horizon: int, name: str) -> Column:
        if name == "uniq_days_amt":
            return days_seen(span, horizon)
        return F.col(f"`{name}@{horizon}`")

    long = (
        wide.select(
            *SUBSCRIBER, "region", F.explode(unpivot_horizons(horizons, names, at)).alias("_h")
        )
        .select(*SUBSCRIBER, "region", "_h.*")
        .filter(F.col("uniq_days_amt") > 0)
    )
    seconds, volume = amounts["_out_sec"], amounts["_bytes"]
    low, high = (seconds.per(F.col(c), 1) for c in ("_voice_low", "_voice_high"))
    equivalent = (low * 20.0 + high * 21.4) / 8192 + volume.per(F.col("_bytes_known"), _MEGABYTE)
    return long.select(
        "horizon",
        day_literal(as_of).alias("calc_date"),
        *SUBSCRIBER,
        "region",
        "uniq_days_amt",
        F.col("_out").alias("call_out_amt"),
        F.col("_in").alias("call_in_amt"),
        seconds.per(F.col("_in_sec"), 60).alias("call_in_duration_min"),
        seconds.per(F.col("_out_sec"), 60).alias("call_out_duration_min"),
        volume.per(F.col("_bytes"), _MEGABYTE).alias("data_vlm_mb"),
        F.when(F.col("_known") > 0, equivalent).alias("voice_gprs_mrg_mb"),
    )


def region_usage(usage: DataFrame, cells: DataFrame, as_of: date | str, days: int) -> DataFrame:
    """``usage_by_region`` for a single window."""
    return usage_by_region(usage, cells, as_of, (days,)).drop("horizon")


def rank_regions(region_usage: DataFrame) -> DataFrame:
    """Known regions of a subscriber by days, equivalent MB, calls out and calls in.

    A subscriber has at most one row per region here, so a window's group is as
    small as the region dimension. The region name breaks ties.
    """
    keys = [c for c in ("horizon", "calc_date") if c in region_usage.columns] + SUBSCRIBER
    order = newest("uniq_days_amt", "voice_gprs_mrg_mb", "call_out_amt", "call_in_amt")
    known = region_usage.filter(F.col("region").isNotNull())
    return ranked(known, keys, [*order, F.col("region").asc()]).select(*keys, "region", "rn")


def primary_region(region_ranks: DataFrame) -> DataFrame:
    """The best ranked region of every subscriber and account.

    On an unmaterialised ranking Catalyst turns the filter into a group limit below
    the window's exchange, so the ranking is not computed in full for it.
    """
    return region_ranks.filter(F.col("rn") == 1).drop("rn").withColumnRenamed("calc_date", "period")
