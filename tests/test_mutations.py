"""Breaking a rule must turn its query red on the stand-ins; else a green row says nothing about the rule."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from martloom.functions import text
from martloom.operators import kpi
from martloom.plans import cells, orders, porting, price_plan, profile
from workloads import queries as q
from workloads.compare import difference


def any_row(df, keys, order):
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in df.columns if c not in keys])


def truncated(df, column):
    return kpi.Amount(column.cast("bigint"), 0)


MUTATIONS = {
    "any sector instead of the newest in service": ("cell_site_actual", cells, "latest_per_key", any_row),
    "4G sectors by their own cell id": ("cell_site_actual", cells, "STATION_KEYED", "none"),
    "4G sectors left out": ("cell_site_actual", cells, "SECTOR_KEYED", ("2G",)),
    "expired operators kept": ("porting_feed", porting, "valid_operators", lambda operators, as_of: operators),
    "operators valid on the expiry day only": (
        "effective_dated_lookup", porting, "valid_operators", lambda operators, as_of: operators,
    ),
    "porting window a minute late": (
        "porting_feed", porting, "porting_window",
        lambda now: (now - timedelta(days=25) + timedelta(minutes=1), now - timedelta(days=20) + timedelta(minutes=10)),
    ),
    "porting window a minute long": (
        "porting_feed", porting, "porting_window",
        lambda now: (now - timedelta(days=25), now - timedelta(days=20) + timedelta(minutes=11)),
    ),
    "contact phone not cut": ("fixed_line_sales", orders, "cut", lambda c, n: c),
    "contact phone cut too short": ("fixed_line_sales", orders, "cut", lambda c, n: text.cut(c, n - 1)),
    "whole seconds only": ("usage_hourly", q.location, "exact", truncated),
    "whole money only": ("profile_arpu", profile, "exact", truncated),
}


@pytest.mark.parametrize("what", MUTATIONS)
def test_mutation_is_seen(spark, sf, monkeypatch, what):
    name, module, attribute, broken = MUTATIONS[what]
    monkeypatch.setattr(module, attribute, broken)
    assert difference(spark, name, sf) is not None


def test_multimedia_messages_count_as_messages(spark, sf, monkeypatch):
    flags = profile._fact_flags
    monkeypatch.setattr(profile, "_fact_flags", lambda: flags() | {"message": F.col("call_type_code") == "S"})
    assert difference(spark, "profile_arpu", sf) is not None


def test_price_plans_differ_with_trimmed_codes(spark, sf):
    t = q.Tables(q.tune(spark), sf)
    groups = [
        price_plan.price_plan_current_prev(t, q.BEFORE, trim_plan_code=trim).agg(F.count("pp_group")).first()[0]
        for trim in (False, True)
    ]
    assert 0 < groups[0] < groups[1]


def test_some_orders_have_no_known_phone(spark, sf):
    found = q.QUERIES["first_match_lookup"](spark, sf).agg(F.count("known_phone").alias("known"), F.count("*").alias("n")).first()
    assert 0 < found.known < found.n
