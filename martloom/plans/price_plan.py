"""Balance snapshot and price-plan history."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_date, day_literal
from martloom.functions.text import clean_code
from martloom.operators.joins import unique_lookup
from martloom.operators.ranking import current_previous, newest


def balances_snapshot(
    balances: DataFrame, as_of: date | str, lag_days: int = 2, day: str = "dt"
) -> DataFrame:
    """The archive's rows of the newest complete day, ``lag_days`` before the run."""
    return balances.filter(
        F.col(day) == day_literal(as_date(as_of) - timedelta(days=lag_days))
    )


def price_plan_current_prev(
    inputs: Mapping[str, DataFrame], as_of: date | str, trim_plan_code: bool = False
) -> DataFrame:
    """Current plan, its group and start, and the previous plan, per subscriber and account.

    The agreements are cut to two per subscriber before any join; only the current
    plan's code is then looked up. ``trim_plan_code`` also trims the code when it
    is matched with the plan list, for extracts that pad codes with blanks.
    """
    effective = inputs["service_agreement"].filter(
        (F.col("service_type") == "P")
        & (F.col("effective_date") < day_literal(as_date(as_of) + timedelta(days=1)))
    )
    plans = current_previous(
        effective.select(
            F.col("subscriber_no").alias("subs_key"),
            F.col("ban").alias("ban_key"),
            "soc",
            "effective_date",
            "sys_creation_date",
            "agreement_id",
        ),
        ["subs_key", "ban_key"],
        newest("effective_date", "sys_creation_date", "agreement_id"),
        current={"curr_price_plan_code": "soc", "price_plan_change_date": "effective_date"},
        previous={"prev_price_plan_code": "soc"},
    )

    def code(c: Column) -> Column:
        return clean_code(c) if trim_plan_code else c

    listed = unique_lookup(inputs["soc"].select(code(F.col("soc")).alias("_soc")), ["_soc"])
    groups = unique_lookup(
        inputs["dim_price_plan"].select(clean_code(F.col("price_plan_key")).alias("_plan"), "pp_group"),
        ["_plan"],
        "pp_group",
    )
    return (
        plans.join(listed, code(F.col("curr_price_plan_code")) == F.col("_soc"), "left")
        .join(groups, clean_code(F.col("_soc")) == F.col("_plan"), "left")
        .select(
            "subs_key",
            "ban_key",
            F.lit(0).alias("arch_pp_ind"),
            "curr_price_plan_code",
            "pp_group",
            "price_plan_change_date",
            "prev_price_plan_code",
        )
    )
