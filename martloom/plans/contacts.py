"""Agent and dealer e-mail contacts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.classify import SURVEYED_ACCOUNTS, customer_segment
from martloom.functions.dates import as_date, day_literal
from martloom.functions.text import first_part
from martloom.operators.joins import lookup_many

# Direction words of the source system, channel and robot account.
OUTGOING = "Исходящий"
INCOMING = "Входящий"
CHANNEL = "Email"
ROBOT = "robot"


def customer_numbers(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Active numbers with the account type of their owner's organisation."""
    types = inputs["table_x_ref_account_type"].filter(F.col("account_type").isin(*SURVEYED_ACCOUNTS))
    organisations = (
        inputs["table_bus_org"]
        .join(types, F.col("type") == F.col("account_type_desc"))
        .select(F.col("objid").alias("_org"), "account_type")
    )
    sites = inputs["table_site"].select(F.col("objid").alias("_site"), F.col("primary2bus_org").alias("_org"))
    parts = inputs["table_site_part"].filter(F.col("part_status") == "Active")
    return (
        parts.select(
            F.col("objid").alias("_part"),
            F.col("site_part2site").alias("_site"),
            F.col("serial_no").alias("ctn"),
        )
        .join(sites, "_site")
        .join(organisations, "_org")
        .select("_part", "ctn", "account_type")
    )


def crm_contacts(
    inputs: Mapping[str, DataFrame],
    as_of: date | str,
    days: int = 10,
    outgoing: str = OUTGOING,
    incoming: str = INCOMING,
) -> DataFrame:
    """E-mails of the last ``days`` days, people's outgoing and the robot's incoming ones.

    People's mails carry the dealer code in the note before ``*`` and need a note;
    the robot's carry it in the title before ``;``. Both kinds pass one scan of the
    interactions and one join with the numbers; the note joins people's rows only.
    """
    as_of = as_date(as_of)
    by_robot = F.col("inserted_by") == ROBOT
    recent = inputs["table_interact"].filter(
        (F.col("type") == CHANNEL)
        & (F.col("create_date") > day_literal(as_of - timedelta(days=days)))
        & (
            (by_robot & (F.col("direction") == incoming))
            | ((F.col("inserted_by") != ROBOT) & (F.col("direction") == outgoing))
        )
    )
    notes = inputs["table_interact_txt"].select(
        F.col("interact_txt2interact").alias("_noted"), "notes"
    )
    contacts = recent.join(
        customer_numbers(inputs), F.col("interact2site_part") == F.col("_part")
    )
    noted = contacts.join(notes, (F.col("objid") == F.col("_noted")) & ~by_robot, "left").filter(
        by_robot | F.col("_noted").isNotNull()
    )
    reasons = lookup_many(
        noted,
        inputs["table_x_int_reason"],
        "objid",
        "x_title",
        {f"x_interact2reason{i}": f"interactionreasons{i}" for i in range(1, 5)},
    )
    return reasons.select(
        "objid",
        "ctn",
        "account_type",
        customer_segment(F.col("account_type")).alias("segment_type"),
        F.col("end_date").alias("interactionendtime"),
        "inserted_by",
        *[f"interactionreasons{i}" for i in range(1, 5)],
        F.col("interact_id").alias("interactionid"),
        F.when(by_robot, first_part(F.col("title"), ";"))
        .otherwise(first_part(F.col("notes"), "*"))
        .alias("posdealercode"),
        day_literal(as_of).alias("creationdate"),
    )
