"""Completed number port-ins."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.classify import porting_direction
from martloom.functions.dates import between_times
from martloom.operators.joins import role_lookup, unique_lookup, valid_on

# Statuses, process types and dictionary codes of a completed port.
DONE = 1
USER_STATUS = 101
PROCESS_TYPES = (2, 5)
STATE_GROUP = 21
STATE_DONE = 6
OWN_OPERATOR = 1


def porting_window(now: datetime) -> tuple[datetime, datetime]:
    """From 25 days before ``now``, included, to 20 days before it plus ten minutes, excluded."""
    return now - timedelta(days=25), now - timedelta(days=20) + timedelta(minutes=10)


def final_user(processes: DataFrame) -> DataFrame:
    """Done processes with the user who entered status 101, if any: a self join."""
    users = processes.filter(F.col("status") == USER_STATUS).select(
        "id", F.col("usr").alias("user_id")
    )
    return processes.filter(F.col("status") == DONE).join(users, "id", "left")


def valid_operators(operators: DataFrame, as_of: date | str) -> DataFrame:
    return operators.filter(
        valid_on(F.col("td"), as_of, last_day_counts=True, open_ended=False)
    )


def porting_feed(inputs: Mapping[str, DataFrame], now: datetime) -> DataFrame:
    """Port-ins to the own operator finished in ``porting_window(now)``, operators valid on the day of ``now``."""
    lo, hi = porting_window(now)
    # The filter moves below the left join, to its left side only: the user of a
    # process may stand on a row with another recipient.
    ports = final_user(inputs["mnp_process"]).filter(
        (F.col("recipient_id") == OWN_OPERATOR) & F.col("process_type_id").isin(*PROCESS_TYPES)
    )
    finals = unique_lookup(
        inputs["mnp_process_statuses"].filter(
            (F.col("is_final") == 1) & (F.col("status_type") == 1) & (F.col("status") == DONE)
        ),
        ["status", "process_type_id"],
        "status_name",
    )
    types = unique_lookup(
        inputs["mnp_process_type"].filter(F.col("id").isin(*PROCESS_TYPES)), ["id"], "uniq"
    ).withColumnRenamed("id", "process_type_id")
    states = unique_lookup(
        inputs["dict_data"]
        .filter((F.col("up") == STATE_GROUP) & (F.col("code") == STATE_DONE))
        .select(F.col("code").alias("_state")),
        ["_state"],
    )
    numbers = (
        inputs["mnp_process_mb"]
        .filter(between_times(F.col("fd"), lo, hi) & (F.col("status") == STATE_DONE))
        .join(states, F.col("status") == F.col("_state"), "left_semi")
        .select(
            F.col("process_id").alias("id"),
            "fd",
            "mob_num",
            "ban",
            "market_id",
            "account_type_id",
            "tmp_mob_num",
        )
    )
    named = role_lookup(
        ports.join(numbers, "id").join(finals, ["status", "process_type_id"]).join(types, "process_type_id"),
        valid_operators(inputs["operators"], now.date()).withColumnRenamed("id", "operator_id"),
        "operator_id",
        {"donor_id": {"code": "donor_name"}, "recipient_id": {"code": "recipient_name"}},
        how="inner",
    )
    return named.select(
        "fd",
        "id",
        "donor_name",
        "recipient_name",
        "uniq",
        "status_name",
        "mob_num",
        "ban",
        "market_id",
        "account_type_id",
        "tmp_mob_num",
        porting_direction(F.col("donor_id"), F.col("recipient_id"), OWN_OPERATOR).alias(
            "portation_type"
        ),
        "dealer_point_id",
        "user_id",
    )
