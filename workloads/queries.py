"""Every registered query: an operator or a mart on the driver's tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import classify, dates, text
from martloom.operators import asof, joins, kpi, ranking, transitions
from martloom.plans import cells, contacts, location, orders, porting, price_plan, profile, recharge, visits
from martloom.sinks import folders, tables
from martloom.sources import readers
from martloom.tuning import tune
from workloads.standins import Tables

# The stand-ins' usage runs from 2024-01-01 to 2024-03-31, orders from 1995 to 2001.
BEFORE = date(2024, 4, 1)  # run date of windows that exclude it
ON = date(2024, 3, 31)  # run date of windows that include it
ALL_DAYS = 90  # days before ON that cover all usage
CONTACTS_ON = date(2024, 1, 30)
ORDERS = ("1998-01-01", "2000-01-01")
FIXED_LINE = ("1998-01-01", "1999-01-01")
PORTED_AT = datetime(1998, 6, 26, 8, 30)
VISITS = ("2024-01-10", "2024-01-20")
MFS = (1, 2, 3)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame], name: str | None = None) -> Callable:
    """Register ``fn``, which sees the tables of the folder the caller names."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(tune(spark), folder))

    QUERIES[name or fn.__name__] = run
    return fn


# --- sources and sinks ------------------------------------------------------


@query
def scan_parquet(t: Tables) -> DataFrame:
    return readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"
    )


def _events_by_day(t: Tables) -> DataFrame:
    return t["events"].select(
        "event_id", "ts", "user_id", "event_type", "value", F.to_date("ts").alias("dt")
    )


@query
def scan_dated(t: Tables) -> DataFrame:
    base = folders.fresh_folder(t.spark, "dated")
    stamped = _events_by_day(t).withColumn("dt", F.date_format("dt", dates.DAY_FOLDER))
    folders.evenly(stamped, "dt").write.partitionBy("dt").parquet(base)
    return readers.read_dated_folders(t.spark, base)


@query
def scan_snapshot(t: Tables) -> DataFrame:
    base = folders.fresh_folder(t.spark, "snapshots")
    folders.overwrite_dates(_events_by_day(t), base)
    return readers.read_snapshot(t.spark, base, date(2024, 1, 20), -3)


@query
def scan_csv_dim(t: Tables) -> DataFrame:
    """Three named columns of a file that has more, in another order."""
    base = folders.fresh_folder(t.spark, "content-list")
    wider = t["dim_bls_content_list"].select(
        F.concat(F.lit("content "), "business_service_key").alias("name"),
        "revenue_stream",
        "business_service_key",
        "business_service_type_key",
    )
    wider.write.csv(base, sep=";", header=True)
    return readers.read_csv_dimension(
        t.spark, base, ["business_service_key", "business_service_type_key", "revenue_stream"]
    )


@query
def sink_roundtrip(t: Tables) -> DataFrame:
    base = folders.fresh_folder(t.spark, "feed")
    path = folders.write_dated_folder(t["fmc_order_data"], base, BEFORE)
    return readers.read_parquet(t.spark, path)


@query
def sink_overwrite_date(t: Tables) -> DataFrame:
    """A dataset of all days, then one day written anew, twice, and one that lost its rows."""
    base = folders.fresh_folder(t.spark, "history")
    folders.overwrite_dates(_events_by_day(t), base)
    day = date(2024, 1, 15)
    changed = (
        t["events"]
        .filter(dates.trailing(F.col("ts"), day, 1, inclusive=True))
        .select("event_id", "ts", "user_id", "event_type", (F.col("value") * 2).alias("value"))
    )
    for _ in range(2):
        folders.overwrite_date(changed, base, day)
    folders.overwrite_date(changed.limit(0), base, date(2024, 1, 16))
    return readers.read_dated(t.spark, base)


_EVENT_COLUMNS = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
}


def _events_table(t: Tables, file_format: str) -> str:
    name = f"events_{uuid.uuid4().hex}"
    tables.create_external_table(
        t.spark, name, _EVENT_COLUMNS, {"dt": "date"}, folders.fresh_folder(t.spark, name), file_format
    )
    folders.at_end(lambda session: session.sql(f"DROP TABLE IF EXISTS {name}"))
    tables.insert_dates(_events_by_day(t), name, "dt")
    return name


@query
def table_partitioned_parquet(t: Tables) -> DataFrame:
    return t.spark.table(_events_table(t, "parquet"))


@query
def table_partitioned_orc(t: Tables) -> DataFrame:
    return t.spark.table(_events_table(t, "orc"))


@query
def table_partition_swap(t: Tables) -> DataFrame:
    """Drop one day, empty one, replace one and add one that the table did not have."""
    name = _events_table(t, "parquet")
    tables.drop_partition(t.spark, name, "dt", "2024-01-10")
    one_day = _events_by_day(t).filter(F.col("dt") == F.lit("2024-01-15").cast("date"))
    for day in ("2024-01-11", "2024-01-15", "2024-02-15"):
        rows = one_day.limit(0) if day == "2024-01-11" else one_day
        tables.swap_partition(
            rows.withColumn("value", F.col("value") + 1),
            name,
            "dt",
            day,
            folders.fresh_folder(t.spark, "swapped"),
        )
    return t.spark.table(name)


@query
def balances_snapshot(t: Tables) -> DataFrame:
    base = folders.fresh_folder(t.spark, "balances")
    snapshot = price_plan.balances_snapshot(t["balance_archive"], date(2024, 3, 17))
    return readers.read_parquet(t.spark, folders.write_dated_folder(snapshot, base, date(2024, 3, 17)))


# --- filters, windows of days, classifications ---------------------------------


@query
def filter_predicates(t: Tables) -> DataFrame:
    keep = (
        F.col("order_status_id").isin(414, 14, 4)
        & ~F.col("fmc_type_id").isin("3")
        & F.col("pre_order_status_id").isNull()
        & F.col("login_fttb").isNotNull()
        & (F.col("user_id") != F.col("sl_dealer_cd"))
        & (((F.col("mon_dealer_cd") >= 3) & (F.col("user_id") > 5)) | (F.col("sl_dealer_cd") < 4))
    )
    return t["fmc_order_data"].filter(keep).select("id", "order_status_id", "fmc_type_id", "login_fttb")


@query
def filter_time_range(t: Tables) -> DataFrame:
    return t["csm_transactions"].filter(
        dates.between_times(F.col("sys_creation_date"), "2024-01-10 08:00:00", "2024-01-12 14:30:00")
    )


@query
def trailing_window(t: Tables) -> DataFrame:
    ts = F.col("call_start_time")
    return (
        t["det_layer"]
        .groupBy("subs_key")
        .agg(
            *[
                F.count_if(dates.trailing(ts, BEFORE, n)).alias(f"before_{n}")
                for n in (7, 30, 90)
            ],
            *[
                F.count_if(dates.trailing(ts, ON, n, inclusive=True)).alias(f"upto_{n}")
                for n in (7, 30, 90)
            ],
        )
    )


@query
def segment_case(t: Tables) -> DataFrame:
    accounts = t["billing_account"].select(
        "ban", classify.customer_segment(F.col("account_type")).alias("segment_type")
    )
    options = t["service_option"].select(
        "ban", classify.customer_language(F.col("soc")).alias("language")
    )
    return (
        options.join(accounts, "ban", "left")
        .groupBy("segment_type", "language")
        .agg(F.count("*").alias("rows"), F.sum("ban").alias("ban_sum"))
    )


@query
def voice_data_equivalent(t: Tables) -> DataFrame:
    usage = location.usage_hourly(t["det_layer"])
    net = joins.unique_lookup(_cells(t), ["lac", "cell_id"], "cell_nettype")
    minutes = F.col("call_in_duration_min") + F.col("call_out_duration_min")
    return usage.join(net, ["lac", "cell_id"], "left").select(
        "period",
        "hhour_id",
        "subs_key",
        "ban_key",
        "lac",
        "cell_id",
        "cell_nettype",
        classify.voice_data_equivalent(minutes, F.col("data_vlm_mb"), F.col("cell_nettype")).alias("eq_mb"),
    )


@query
def effective_dated_lookup(t: Tables) -> DataFrame:
    numbers = t["fmc_gsm"].filter(
        joins.valid_on(F.col("expiration_date"), "2024-04-01", last_day_counts=False, open_ended=True)
    )
    operators = porting.valid_operators(t["operators"], date(2000, 1, 1))
    return numbers.select(F.lit("number").alias("kind"), F.col("fmc_order_id").alias("id")).unionByName(
        operators.select(F.lit("operator").alias("kind"), F.col("id").cast("bigint").alias("id"))
    )


# --- joins -----------------------------------------------------------------


def _cells(t: Tables) -> DataFrame:
    """The cell dimension, part of its consumers' plans."""
    if not t.has("cell_site_actual"):
        t["cell_site_actual"] = cells.cell_site_actual(t)
    return t["cell_site_actual"]


@query
def cell_site_actual(t: Tables) -> DataFrame:
    return cells.cell_site_actual(t)


@query
def join_composite(t: Tables) -> DataFrame:
    keys = ["mtr_classification_key", "parent_mtr_key"]
    sources = joins.unique_lookup(t["dim_mtr_classification"], keys, "description")
    return (
        t["det_layer"]
        .join(sources, keys)
        .groupBy(*keys, "description")
        .agg(F.count("*").alias("rows"), F.sum("recharge_amt").cast("decimal(28,2)").alias("amount"))
    )


@query
def left_join_on_filter(t: Tables) -> DataFrame:
    numbers = t["fmc_gsm"].withColumnRenamed("fmc_order_id", "id")
    return joins.left_join_where(
        t["fmc_order_data"].select("id", "fmc_type_id"), numbers, ["id"], F.col("sign_main_gsm") == "1"
    )


@query
def join_clean_key(t: Tables) -> DataFrame:
    plans = t["soc"].select(text.clean_code(F.col("soc")).alias("_code"), "soc_description")
    sectors = (
        t["dir_sector"]
        .filter(F.col("lac_tac").isNotNull())
        .groupBy(F.col("lac_tac").alias("_lac"))
        .agg(F.count("*").alias("sectors"))
    )
    agreements = (
        t["service_agreement"]
        .join(
            joins.unique_lookup(plans, ["_code"], "soc_description"),
            text.clean_code(F.col("soc")) == F.col("_code"),
            "left",
        )
        .groupBy("soc", "soc_description")
        .agg(F.count("*").alias("rows"))
        .select(F.lit("plan").alias("kind"), F.col("soc").alias("code"), "soc_description", "rows")
    )
    usage = (
        t["det_layer"]
        .groupBy(text.clean_id(F.col("lac")).alias("_lac"))
        .agg(F.count("*").alias("rows"))
        .join(sectors, "_lac")
        .select(
            F.lit("lac").alias("kind"),
            F.col("_lac").cast("string").alias("code"),
            F.col("sectors").cast("string").alias("soc_description"),
            "rows",
        )
    )
    return agreements.unionByName(usage)


@query
def prior_order_fmc(t: Tables) -> DataFrame:
    """All orders that reached a bundle status, each with its login's latest earlier order."""
    reached = orders.reached_orders(
        t["fmc_order_data"], t["fmc_change_status_log"], orders.BUNDLE, *ORDERS
    )
    return orders.with_prior_order(reached, t["fmc_order_data"])


@query
def asof_prior_record(t: Tables) -> DataFrame:
    return asof.prior_record(
        t["fmc_order_data"],
        "login_fttb",
        "id",
        {"prev_req_id": "id", "prev_req_status": "order_status_id", "prev_req_date": "order_status_date"},
    )


@query
def self_join_status(t: Tables) -> DataFrame:
    return porting.final_user(t["mnp_process"])


@query
def role_playing_dim(t: Tables) -> DataFrame:
    return joins.role_lookup(
        t["mnp_process"].select("id", "status", "donor_id", "recipient_id"),
        t["operators"].withColumnRenamed("id", "operator_id"),
        "operator_id",
        {"donor_id": {"code": "donor_name"}, "recipient_id": {"code": "recipient_name"}},
    )


@query
def semi_join_status(t: Tables) -> DataFrame:
    return orders.connected_orders(t["suz_order_data"], t["change_order_status_log"], *FIXED_LINE).select(
        "id", "login", "ban"
    )


@query
def scalar_lookup(t: Tables) -> DataFrame:
    return joins.lookup_many(
        t["table_interact"],
        t["table_x_int_reason"],
        "objid",
        "x_title",
        {f"x_interact2reason{i}": f"reason{i}" for i in range(1, 5)},
    ).select("objid", "reason1", "reason2", "reason3", "reason4")


@query
def first_match_lookup(t: Tables) -> DataFrame:
    wanted = t["suz_order_data"].select("id", "phone", "phone2", "phone3")
    return joins.first_match(
        wanted, "id", ["phone", "phone2", "phone3"], t["subscriber"], "subscriber_no", "known_phone"
    )


# --- aggregates, rankings, set operations -------------------------------------


@query
def conditional_kpi(t: Tables) -> DataFrame:
    charge = kpi.exact(t["det_layer"], F.col("charge_amt") + F.col("vat_amt"))
    return kpi.conditional_metrics(
        t["det_layer"],
        ["subs_key", "ban_key"],
        flags={
            "usage": F.col("src").isin("CHA", "PSA", "ROAM", "GPRS"),
            "voice": F.col("call_type_code") == "V",
            "outgoing": F.col("call_direction_ind") == "2",
            "topup": recharge.is_topup(),
        },
        values={
            "charge": charge.units,
            "amount": F.col("recharge_amt"),
            "start": F.col("call_start_time"),
        },
        metrics=[
            kpi.Metric("usage_charge", "total", "charge", ("usage",)),
            kpi.Metric("voice_out_calls", "count", None, ("usage", "voice", "outgoing")),
            kpi.Metric("last_voice_out", "latest", "start", ("usage", "voice", "outgoing")),
            kpi.Metric("max_topup", "peak", "amount", ("topup",)),
        ],
        finish={"charge": charge.total},
    )


@query
def distinct_pairs(t: Tables) -> DataFrame:
    return (
        t["service_option"]
        .filter((F.col("service_type") == "O") & F.col("soc").isin("ICLM_RUS", "ICLM_KAZ"))
        .select("ban", "soc")
        .distinct()
    )


@query
def latest_per_key(t: Tables) -> DataFrame:
    return ranking.latest_per_key(t["orders"], ["o_custkey"], ranking.newest("o_orderdate", "o_orderkey"))


@query
def top_k_per_group(t: Tables) -> DataFrame:
    return ranking.top_k(
        t["service_agreement"],
        ["subscriber_no", "ban"],
        ranking.newest("effective_date", "sys_creation_date", "agreement_id"),
        2,
    ).select("subscriber_no", "ban", "agreement_id", "soc", "rn")


@query
def status_transitions(t: Tables) -> DataFrame:
    wanted = (414, 14)
    return transitions.status_transitions(
        t["fmc_order_data"],
        F.col("order_status_id").isin(*wanted) & F.col("pre_order_status_id").isNull(),
        ("id", "order_status_id", "order_status_date"),
        t["fmc_change_status_log"],
        F.col("pre_order_status_id").isin(*wanted),
        ("fmc_order_id", "pre_order_status_id", "pre_order_status_date"),
    )


# --- scalar functions -----------------------------------------------------


@query
def fn_strings(t: Tables) -> DataFrame:
    return t["suz_order_data"].select(
        "id",
        F.trim("phone").alias("trimmed"),
        F.length("phone").cast("bigint").alias("len"),
        text.cut(F.col("sl_dealer_name"), 3).alias("cut3"),
        F.substring(F.col("order_status_date").cast("string"), 1, 10).alias("day_text"),
        text.drop_head(F.col("login")).alias("tail"),
        text.joined("ENS_", F.col("id"), "_", F.col("sl_dealer_name")).alias("visit_id"),
        text.joined("pre_", F.col("pre_order_status_id")).alias("null_part"),
    )


@query
def fn_regex(t: Tables) -> DataFrame:
    return (
        t["table_interact"]
        .join(t["table_interact_txt"], F.col("objid") == F.col("interact_txt2interact"))
        .select(
            "objid",
            text.first_part(F.col("title"), ";").alias("title_part"),
            text.first_part(F.col("notes"), "*").alias("note_part"),
            text.digits(F.col("notes")).alias("note_digits"),
        )
    )


@query
def fn_casts(t: Tables) -> DataFrame:
    return t["det_layer"].select(
        "subs_key",
        text.clean_id(F.col("lac")).alias("lac_id"),
        text.clean_id(F.col("src")).alias("src_id"),
        text.clean_id(F.col("cell_id")).cast("decimal(30,0)").alias("cell_dec"),
        F.to_date("call_start_time").alias("day"),
        F.col("call_start_time").cast("string").try_cast("date").alias("day_from_text"),
        F.col("src").try_cast("bigint").alias("bad_cast"),
    )


@query
def fn_math(t: Tables) -> DataFrame:
    return t["det_layer"].select(
        "subs_key",
        F.abs("charge_amt").cast("decimal(18,4)").alias("abs_charge"),
        (F.col("charge_amt") + F.col("vat_amt")).cast("decimal(20,4)").alias("gross"),
        (F.col("charge_amt") - F.col("vat_amt")).cast("decimal(20,4)").alias("net"),
        (F.col("actual_call_duration_sec").cast("double") / 60).alias("minutes"),
        (F.col("rounded_data_volume") / 1024 / 1024).alias("megabytes"),
        (F.col("actual_call_duration_sec") * 1024).cast("decimal(28,1)").alias("scaled"),
    )


@query
def fn_dates(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t["orders"].select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
        F.date_format("o_orderdate", "HH").alias("hour_text"),
        F.date_format("o_orderdate", dates.DAY_FOLDER).alias("day_folder"),
        F.date_format("o_orderdate", dates.MONTH_FOLDER).alias("month_folder"),
        F.date_add(day, 30).alias("plus_30"),
        F.date_sub(day, 10).alias("minus_10"),
        F.add_months(day, 1).alias("next_month"),
        dates.truncate_date(day, "Month").alias("month_start"),
        dates.truncate_date(day, "day").alias("unchanged"),
        dates.first_of_month(day, "ddMMyyyy").alias("month_start_folder"),
        F.last_day(day).alias("month_end"),
        dates.previous_month_start(day).alias("sysmonth"),
        dates.start_of_day(F.col("o_orderdate")).alias("day_start"),
        dates.end_of_day(F.col("o_orderdate")).alias("day_end"),
        (F.col("o_orderdate") - F.expr("interval '20' day") + F.expr("interval '10' minute")).alias("shifted"),
        dates.abs_day_diff(F.lit(ON), day).cast("bigint").alias("day_gap"),
    )


# --- marts -----------------------------------------------------------------


@query
def usage_hourly(t: Tables) -> DataFrame:
    return location.usage_hourly(t["det_layer"])


def _region_usage(t: Tables, days: int) -> DataFrame:
    return location.region_usage(location.usage_hourly(t["det_layer"]), _cells(t), BEFORE, days)


def _region_rank(t: Tables, days: int) -> DataFrame:
    return location.rank_regions(_region_usage(t, days))


def _primary_region(t: Tables, days: int) -> DataFrame:
    return location.primary_region(_region_rank(t, days))


def _recharge_source(t: Tables, days: int) -> DataFrame:
    return recharge.recharge_source(t["det_layer"], t["dim_mtr_classification"], ON, days)


_WINDOWS = {"weekly": 7, "monthly": 30, "3month": 90}
for _suffix, _days in _WINDOWS.items():
    query(partial(_region_usage, days=_days), f"region_usage_{_suffix}")
    query(partial(_region_rank, days=_days), f"region_rank_{_suffix}")
    query(partial(_primary_region, days=_days), f"primary_region_{_suffix}")
    query(partial(_recharge_source, days=_days), f"recharge_source_{_suffix}")


@query
def primary_region_horizons(t: Tables) -> DataFrame:
    """The three windows' primary regions from one scan of the usage."""
    usage = location.usage_hourly(t["det_layer"])
    return location.primary_region(
        location.rank_regions(location.usage_by_region(usage, _cells(t), BEFORE))
    )


@query
def recharge_source_horizons(t: Tables) -> DataFrame:
    return recharge.recharge_by_source(t["det_layer"], t["dim_mtr_classification"], ON)


@query
def location_pipeline(t: Tables) -> DataFrame:
    """Hourly usage, region usage, ranking and primary region, each written and read back."""
    usage = folders.materialise(location.usage_hourly(t["det_layer"]), "usage-hourly")
    by_region = folders.materialise(
        location.region_usage(usage, _cells(t), BEFORE, 30), "region-usage"
    )
    ranks = folders.materialise(location.rank_regions(by_region), "region-rank")
    return location.primary_region(ranks)


@query
def price_plan_current_prev(t: Tables) -> DataFrame:
    return price_plan.price_plan_current_prev(t, date(2024, 4, 1))


@query
def price_plan_padded_codes(t: Tables) -> DataFrame:
    return price_plan.price_plan_current_prev(t, date(2000, 6, 30), trim_plan_code=True)


def _profile(t: Tables, families=tuple(profile.FAMILIES), days_back: int = ALL_DAYS) -> DataFrame:
    if {"data"} & set(families):
        _cells(t)
    return profile.profile(t, ON, families, days_back, MFS)


query(_profile, "subscriber_profile")
query(partial(_profile, days_back=3), "subscriber_profile_daily")
for _family in profile.FAMILIES:
    query(partial(_profile, families=(_family,)), f"profile_{_family}")


@query
def crm_contacts(t: Tables) -> DataFrame:
    return contacts.crm_contacts(t, CONTACTS_ON, outgoing="OUT", incoming="IN")


@query
def bundle_sales(t: Tables) -> DataFrame:
    return orders.bundle_sales(t, date(2024, 4, 1), *ORDERS)


@query
def tv_sales(t: Tables) -> DataFrame:
    return orders.tv_sales(t, *ORDERS)


@query
def fixed_line_sales(t: Tables) -> DataFrame:
    return orders.fixed_line_sales(t, *FIXED_LINE)


@query
def porting_feed(t: Tables) -> DataFrame:
    return porting.porting_feed(t, PORTED_AT)


@query
def service_visits(t: Tables) -> DataFrame:
    options = {"service_agreement": t["service_option"]}
    inputs = {**t.pick("csm_transactions", "billing_account", "subscriber"), **options}
    return visits.service_visits(inputs, *VISITS)
