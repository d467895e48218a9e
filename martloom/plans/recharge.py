"""Ranking of a subscriber's top-up sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_date, day_literal, trailing
from martloom.operators.joins import unique_lookup
from martloom.operators.kpi import exact
from martloom.operators.horizons import sum_within, unpivot_horizons
from martloom.operators.ranking import newest, ranked

SUBSCRIBER = ["subs_key", "ban_key"]
HORIZONS = (7, 30, 90)

# Record source, top-up channels and classification target.
TOPUP_SOURCE = "RHA"
TOPUP_CHANNELS = ("E", "S", "B")
TOPUP_TARGET = "FCT_PREPAID_RECHARGES"


def is_topup() -> Column:
    return (
        (F.col("src") == TOPUP_SOURCE)
        & F.col("recharge_source").isin(*TOPUP_CHANNELS)
        & (F.col("recharge_amt") > 0)
    )


def recharge_by_source(
    det_layer: DataFrame,
    classification: DataFrame,
    as_of: date | str,
    horizons: Sequence[int] = HORIZONS,
) -> DataFrame:
    """Top-up totals, counts and source rank over windows that include ``as_of``.

    One scan of the longest window serves every horizon. Totals are partial sums
    per subscriber and source before the exchange; the ranking then sees at most one
    row per source and subscriber.
    """
    as_of = as_date(as_of)
    span = max(horizons)
    amount = exact(det_layer, F.col("recharge_amt"))
    sources = unique_lookup(
        classification.filter(F.col("target_table_name") == TOPUP_TARGET),
        ["mtr_classification_key", "parent_mtr_key"],
        "description",
    )
    topups = (
        det_layer.filter(
            is_topup() & trailing(F.col("call_start_time"), as_of, span, inclusive=True)
        )
        .select(
            *SUBSCRIBER,
            "mtr_classification_key",
            "parent_mtr_key",
            amount.units.alias("_units"),
            F.datediff(day_literal(as_of), F.to_date("call_start_time")).alias("_age"),
        )
        .join(sources, ["mtr_classification_key", "parent_mtr_key"])
    )
    age = F.col("_age")
    one = F.lit(1).cast("bigint")
    wide = topups.groupBy(*SUBSCRIBER, F.col("description").alias("rech_src_desc")).agg(
        *[sum_within(age, h, F.col("_units")).alias(f"_units@{h}") for h in horizons],
        *[sum_within(age, h, one).alias(f"rech_count@{h}") for h in horizons],
    )
    names = ("_units", "rech_count")
    long = (
        wide.select(
            *SUBSCRIBER,
            "rech_src_desc",
            F.explode(
                unpivot_horizons(horizons, names, lambda h, n: F.col(f"`{n}@{h}`"))
            ).alias("_h"),
        )
        .select(*SUBSCRIBER, "rech_src_desc", "_h.*")
        .filter(F.col("rech_count") > 0)
    )
    order = [*newest("_units", "rech_count"), F.col("rech_src_desc").asc()]
    return ranked(long, ["horizon", *SUBSCRIBER], order).select(
        "horizon",
        *SUBSCRIBER,
        "rech_src_desc",
        amount.total(F.col("_units")).alias("total_rech_amt"),
        "rech_count",
        "rn",
    )


def recharge_source(
    det_layer: DataFrame, classification: DataFrame, as_of: date | str, days: int
) -> DataFrame:
    """``recharge_by_source`` for a single window."""
    return recharge_by_source(det_layer, classification, as_of, (days,)).drop("horizon")
