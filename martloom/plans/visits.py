"""Service visits that trigger a survey."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.classify import (
    LANGUAGE_BY_OPTION,
    SURVEYED_ACCOUNTS,
    customer_language,
    customer_segment,
)
from martloom.functions.dates import between_times
from martloom.functions.text import joined

# Activity codes with the reasons they need; an empty list is any reason.
VISIT_CODES: dict[str, tuple[str, ...]] = {
    "MCN": ("ATNO",),
    "RPS": ("RPSW",),
    "CPP": ("CPPR",),
    "CCN": ("CCNW",),
    "RSP": ("RSBO", "RSB"),
    "C16": (),
    "C17": (),
    "B05": (),
    "B02": (),
    "B60": (),
    "B00": (),
    "B08": (),
    "UAE": (),
}
TEST_OPERATORS = "999%"


def is_visit(activity: Column, reason: Column) -> Column:
    any_reason = [code for code, reasons in VISIT_CODES.items() if not reasons]
    with_reason = [
        (activity == code) & reason.isin(*reasons) for code, reasons in VISIT_CODES.items() if reasons
    ]
    return reduce(lambda a, b: a | b, with_reason, activity.isin(*any_reason))


def service_visits(inputs: Mapping[str, DataFrame], lo, hi) -> DataFrame:
    """Visits in ``[lo, hi)`` per active number of a surveyed account.

    ``service_agreement`` holds the language options. An account with both
    languages gives a row for each.
    """
    visits = inputs["csm_transactions"].filter(
        between_times(F.col("sys_creation_date"), lo, hi)
        & is_visit(F.col("actv_code"), F.col("actv_rsn_code"))
        & ~F.col("operator_id").like(TEST_OPERATORS)
    )
    accounts = (
        inputs["billing_account"]
        .filter(F.col("account_type").isin(*SURVEYED_ACCOUNTS))
        .select("ban", "account_type")
    )
    numbers = (
        inputs["subscriber"]
        .filter(F.col("sub_status") == "A")
        .select(F.col("customer_id").alias("ban"), "subscriber_no")
    )
    languages = (
        inputs["service_agreement"]
        .filter((F.col("service_type") == "O") & F.col("soc").isin(*LANGUAGE_BY_OPTION))
        .select("ban", "soc")
        .distinct()
    )
    return (
        visits.join(accounts, "ban")
        .join(numbers, "ban")
        .join(languages, "ban", "left")
        .select(
            "actv_code",
            "actv_rsn_code",
            "ban",
            "subscriber_no",
            customer_segment(F.col("account_type")).alias("segment_type"),
            "sys_creation_date",
            "operator_id",
            joined("ENS_", F.col("trx_seq_no"), "_", F.col("actv_code")).alias("visit_id"),
            customer_language(F.col("soc")).alias("language"),
        )
    )
