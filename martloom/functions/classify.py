"""CASE classifications; a value outside the lists gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Account types of the two customer segments.
CONSUMER_ACCOUNTS = ("13", "113", "37", "39")
BUSINESS_ACCOUNTS = ("41",)
SURVEYED_ACCOUNTS = CONSUMER_ACCOUNTS + BUSINESS_ACCOUNTS

# Option codes that carry the customer's language.
LANGUAGE_BY_OPTION = {"ICLM_RUS": "RUS", "ICLM_KAZ": "KAZ"}


def customer_segment(account_type: Column) -> Column:
    return F.when(account_type.isin(*CONSUMER_ACCOUNTS), "B2C").when(
        account_type.isin(*BUSINESS_ACCOUNTS), "B2B"
    )


def customer_language(option: Column) -> Column:
    case = F
    for code, language in LANGUAGE_BY_OPTION.items():
        case = case.when(option == code, language)
    return case


def porting_direction(donor: Column, recipient: Column, own_operator: int = 1) -> Column:
    return F.when(donor == own_operator, "PORT OUT").when(recipient == own_operator, "PORT IN")


def home_network(roaming: Column, roaming_type: Column) -> Column:
    """Traffic carried by the home network."""
    return ((roaming == "0") & roaming_type.isin("H", "X")) | (
        (roaming == "1") & (roaming_type == "R")
    )


def equivalent_rate(net_type: Column) -> Column:
    """Kilobits per second one minute of voice stands for, by cell technology.

    A cell that is not in the dimension counts as 2G, 4G voice counts nothing and
    any other technology is NULL.
    """
    # 2 * (16 * 0.25 + 8 * 0.75) = 20 for 2G, 21.4 for 3G.
    return (
        F.when(net_type.isNull() | (net_type == "2G"), F.lit(20.0))
        .when(net_type == "3G", F.lit(21.4))
        .when(net_type == "4G", F.lit(0.0))
    )


def voice_data_equivalent(minutes: Column, megabytes: Column, net_type: Column) -> Column:
    """Voice and data of one row as megabytes: ``minutes * 60 * rate / 8192 + MB``."""
    return minutes * 60 * equivalent_rate(net_type) / 8192 + megabytes
