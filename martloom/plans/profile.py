"""Daily subscriber profile: 74 conditional metrics in six families."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.classify import home_network
from martloom.functions.dates import as_date, day_literal
from martloom.functions.text import clean_id
from martloom.operators.joins import role_lookup, unique_lookup
from martloom.operators.kpi import Amount, Metric, aggregate_packed, bit_positions, exact, pack
from martloom.plans.recharge import is_topup

KEYS = ["subs_key", "ban_key", "period"]

# Service keys of the mobile financial services, own operator code
# and dial codes of the three countries reported one by one.
MFS_SERVICES = (524506, 524507, 525058)
OWN_OPERATOR = "130"
COUNTRIES = {"rus": "7", "uzb": "998", "krgz": "996"}
# Revenue streams of the service type dimension.
STREAMS = {"voice": 1, "sms": 3, "data": 4, "roam": 9, "bundle": 42}


def _revenue_metrics() -> list[Metric]:
    def arpu(name: str, *when: str) -> Metric:
        return Metric(f"subs_{name}arpu_daily", "total", "revenue", when)

    return [
        arpu("", "any_charge"),
        arpu("bundle_", "any_charge", "no_content", "stream_bundle"),
        *[arpu(f"{s}_", "usage_charge", "no_content", f"stream_{s}") for s in ("voice", "data", "sms")],
        arpu("content_", "any_charge", "content"),
        arpu("roam_", "any_charge", "no_content", "stream_roam"),
        arpu("roam_voice_", "usage_charge", "no_content", "stream_roam", "voice"),
        arpu("roam_smsmms_", "usage_charge", "no_content", "stream_roam", "message"),
        arpu("roam_gprs_", "usage_charge", "no_content", "stream_roam", "data"),
        arpu("roam_content_", "service_charge", "no_content", "stream_roam"),
    ]


# What a call's other end has to be. Local fixed lines count special numbers too,
# and calls abroad from home count any line type.
_LOCAL_PARTNER = {
    "onnet": ("mobile", "local", "ordinary", "onnet"),
    "offnet": ("mobile", "local", "ordinary", "offnet"),
    "fix": ("fixed", "local"),
}
_ROAM_PARTNER = {
    "onnet": ("mobile", "local", "ordinary", "onnet"),
    "offnet": ("mobile", "local", "ordinary", "offnet"),
    "fix": ("fixed", "local", "ordinary"),
    "inter": ("abroad", "ordinary"),
}


def _voice_metrics() -> list[Metric]:
    out: list[Metric] = []
    for way in ("out", "in"):
        home = ("used", "voice", way, "home", "counted")
        away = ("used", "voice", way, "roaming", "counted")

        def three(scope: str, call: str, when: tuple[str, ...]) -> list[Metric]:
            return [
                Metric(f"v_{scope}_min", "total", "seconds", when),
                Metric(f"v_{scope}_call_amt", "count", None, when),
                Metric(f"last_{way}_v_{call}_call", "latest", "call_start_time", when),
            ]

        for partner, flags in _LOCAL_PARTNER.items():
            out += three(f"{way}_{partner}_loc", f"{partner}_loc", home + flags)
        out += three(f"{way}_inter", "inter", home + ("abroad",))
        far_end = "called" if way == "out" else "caller"
        for country in COUNTRIES:
            when = home + ("abroad", f"{far_end}_{country}")
            out.append(Metric(f"v_{way}_inter_{country}_min", "total", "seconds", when))
        out.append(Metric(f"v_{way}_roam_min", "total", "seconds", away))
        out.append(Metric(f"v_{way}_roam_call_amt", "count", None, away))
        for partner, flags in _ROAM_PARTNER.items():
            out.append(Metric(f"v_{way}_{partner}_roam_min", "total", "seconds", away + flags))
    return out


def _data_metrics() -> list[Metric]:
    def volume(kind: str, *when: str) -> Metric:
        return Metric(f"gprs_data_mb_vlm_{kind}", "total", "bytes", ("used", "data", "counted", *when))

    return [
        volume("2g", "home", "no_lte", "cell_2g"),
        volume("3g", "home", "no_lte", "cell_3g"),
        volume("4g", "home", "lte_or_4g"),
        volume("roam", "roaming"),
    ]


def _sms_metrics() -> list[Metric]:
    out: list[Metric] = []
    for way in ("out", "in"):
        base = ("used", "sms", way, "counted")

        def sent(scope: str, *when: str) -> Metric:
            return Metric(f"s_{way}_{scope}_sms_amt", "count", None, base + when)

        out += [
            sent("onnet_loc", "home", *_LOCAL_PARTNER["onnet"]),
            sent("offnet_loc", "home", *_LOCAL_PARTNER["offnet"]),
            sent("inter", "home", "mobile", "abroad", "ordinary"),
            sent("roam", "roaming"),
        ]
    return out


def _mfs_metrics() -> list[Metric]:
    out: list[Metric] = []
    for kind, value, flag in (("write_off", "revenue", "debit"), ("recharge", "turnover", "credit")):
        out += [
            Metric(f"total_mfs_{kind}_amt", "total", value, ("mfs", flag)),
            Metric(f"max_mfs_{kind}_amt", "peak", value, ("mfs", flag)),
            Metric(f"max_mfs_{kind}_count", "count", None, ("mfs", flag)),
        ]
    return out


def _topup_metrics() -> list[Metric]:
    return [
        Metric("total_topup_amt", "total", "recharge", ("topup",)),
        Metric("max_topup_amt", "peak", "recharge", ("topup",)),
        Metric("topup_count", "count", None, ("topup",)),
    ]


FAMILIES: dict[str, list[Metric]] = {
    "arpu": _revenue_metrics(),
    "voice": _voice_metrics(),
    "data": _data_metrics(),
    "sms": _sms_metrics(),
    "mfs": _mfs_metrics(),
    "topup": _topup_metrics(),
}


def _fact_flags() -> dict[str, Column]:
    """Conditions on the usage row alone."""
    src, kind = F.col("src"), F.col("call_type_code")
    usage = src.isin("CHA", "PSA", "ROAM", "GPRS")
    service = (src == "CHR") & F.col("charge_type").isin("O", "R")
    orig, term = F.col("orig_parent_operator_code"), F.col("term_parent_operator_code")
    one_off = (src == "CHR") & (F.col("charge_type") == "N")
    return {
        "usage_charge": usage,
        "service_charge": service,
        "any_charge": usage | service,
        "used": usage | (src == "POST"),
        "voice": kind == "V",
        "data": kind == "G",
        "sms": kind == "S",
        "message": kind.isin("S", "M"),
        "out": F.col("call_direction_ind") == "2",
        "in": F.col("call_direction_ind") == "1",
        "mobile": F.col("connection_type_key") == "3",
        "fixed": F.col("connection_type_key").isin("1", "2"),
        "local": F.col("location_type_key").isin("1", "2"),
        "abroad": F.col("location_type_key") == "3",
        "ordinary": F.col("special_number_ind") == "0",
        "home": home_network(F.col("roaming_ind"), F.col("roaming_type_key")),
        "roaming": (F.col("roaming_ind") > "0") & ~F.col("roaming_type_key").isin("R", "X"),
        "counted": F.col("counted_cdr_ind") == "1",
        "onnet": (orig == term) & (term == OWN_OPERATOR),
        "offnet": orig != term,
        "no_lte": F.col("network_type") != "L",
        "debit": one_off & (F.col("charge_amt") > 0),
        "credit": one_off & (F.col("charge_amt") < 0),
        "topup": is_topup(),
    }


def _service_flags(mfs_services: Sequence[int]) -> dict[str, Column]:
    return {
        "content": F.col("_content").isNotNull(),
        "no_content": F.col("_content").isNull(),
        "mfs": F.col("_service").isin(*mfs_services),
        **{f"stream_{name}": F.col("_stream") == code for name, code in STREAMS.items()},
    }


def _country_flags() -> dict[str, Column]:
    return {
        f"{end}_{country}": F.col(f"_{end}") == code
        for end in ("caller", "called")
        for country, code in COUNTRIES.items()
    }


def _cell_flags() -> dict[str, Column]:
    """An unknown cell is no technology here, unlike in the location score."""
    net = F.col("_net")
    return {
        "cell_2g": ~net.isin("3G", "4G"),
        "cell_3g": net == "3G",
        "lte_or_4g": F.col("_lte") | (net == "4G"),
    }


def _amounts(fact: DataFrame) -> dict[str, Amount]:
    """What is summed, exactly in any order."""
    revenue = exact(fact, F.col("charge_amt") + F.col("vat_amt"))
    return {
        "revenue": revenue,
        "turnover": Amount(F.abs(revenue.units), revenue.scale),
        "recharge": exact(fact, F.col("recharge_amt")),
        "seconds": exact(fact, F.col("actual_call_duration_sec")),
        "bytes": exact(fact, F.col("rounded_data_volume")),
    }


# Seconds in a minute and bytes in a megabyte.
_PARTS = {"seconds": 60, "bytes": 1048576}


def _finish(amounts: Mapping[str, Amount]) -> dict[str, Callable[[Column], Column]]:
    def of(name: str, amount: Amount) -> Callable[[Column], Column]:
        return (lambda total: amount.per(total, _PARTS[name])) if name in _PARTS else amount.total

    return {name: of(name, amount) for name, amount in amounts.items()}


def _with_service(fact: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Service key, revenue stream and content-list membership of every row.

    The lookups stay a chain on the fact, each with its own small size estimate, so
    Spark can broadcast all of them and the fact is not shuffled for any.
    """
    services = unique_lookup(
        inputs["dim_business_service"].select(
            F.col("business_service_key").alias("_service"),
            F.col("business_service_type_key").alias("_type_of_service"),
        ),
        ["_service"],
        "_type_of_service",
    )
    types = unique_lookup(
        inputs["dim_business_service_type"].select(
            F.col("business_service_type_key").alias("_type"), F.col("revenue_stream").alias("_stream")
        ),
        ["_type"],
        "_stream",
    )
    # The content list is delimited text, so its keys arrive as strings.
    content = unique_lookup(
        inputs["dim_bls_content_list"].select(
            F.col("business_service_key").try_cast("bigint").alias("_content"),
            F.col("business_service_type_key").try_cast("bigint").alias("_content_type"),
            F.col("revenue_stream").try_cast("bigint").alias("_content_stream"),
        ),
        ["_content", "_content_type", "_content_stream"],
    )
    return (
        fact.join(services, fact["business_service_key"] == services["_service"], "left")
        .join(types, F.col("_type_of_service") == F.col("_type"), "left")
        .join(
            content,
            (F.col("_service") == F.col("_content"))
            & (F.col("_type") == F.col("_content_type"))
            & (F.col("_stream") == F.col("_content_stream")),
            "left",
        )
    )


def _with_countries(fact: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    return role_lookup(
        fact,
        inputs["dim_global_digit"],
        "dial_digit_key",
        {
            "dial_digit_key_from": {"country_code": "_caller"},
            "dial_digit_key_to": {"country_code": "_called"},
        },
    )


def _with_cell(fact: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Technology of the cell; ``lac`` and ``cell_id`` were cleaned before."""
    cells = unique_lookup(
        inputs["cell_site_actual"].select(
            F.col("lac").cast("bigint").alias("_lac"),
            F.col("cell_id").cast("bigint").alias("_cell"),
            F.col("cell_nettype").alias("_net"),
        ),
        ["_lac", "_cell"],
        "_net",
    )
    return fact.join(cells, (F.col("lac") == F.col("_lac")) & (F.col("cell_id") == F.col("_cell")), "left")


def _lookups(mfs_services: Sequence[int]) -> list[tuple]:
    """Per dimension: the fact columns it needs, the join, and the flags it decides."""
    return [
        ({"business_service_key": F.col("business_service_key")}, _with_service, _service_flags(mfs_services)),
        (
            {c: F.col(c) for c in ("dial_digit_key_from", "dial_digit_key_to")},
            _with_countries,
            _country_flags(),
        ),
        (
            {
                "lac": clean_id(F.col("lac")),
                "cell_id": clean_id(F.col("cell_id")),
                "_lte": F.col("network_type") == "L",
            },
            _with_cell,
            _cell_flags(),
        ),
    ]


def profile(
    inputs: Mapping[str, DataFrame],
    as_of: date | str,
    families: Sequence[str] = tuple(FAMILIES),
    days_back: int = 3,
    mfs_services: Sequence[int] = MFS_SERVICES,
) -> DataFrame:
    """Metrics of the given families per subscriber, account and day.

    Days from ``as_of - days_back`` to ``as_of`` are included. Rows are reduced to
    keys, values and one long of flags before any join, so the lookups (only those
    the families need) carry a narrow row whether they broadcast or shuffle.
    """
    as_of = as_date(as_of)
    metrics = [m for family in families for m in FAMILIES[family]]
    bits = bit_positions(metrics)
    amounts = _amounts(inputs["det_layer"])
    sources = {n: a.units for n, a in amounts.items()} | {"call_start_time": F.col("call_start_time")}
    values = {m.value: sources[m.value] for m in metrics if m.value}
    lookups = [entry for entry in _lookups(mfs_services) if bits.keys() & entry[2].keys()]
    started = F.col("call_start_time")
    in_window = (started >= day_literal(as_of - timedelta(days=days_back))) & (
        started < day_literal(as_of + timedelta(days=1))
    )
    join_keys = {name: c for needs, _, _ in lookups for name, c in needs.items()}
    rows = (
        inputs["det_layer"]
        .filter(in_window)
        .select(
            "subs_key",
            "ban_key",
            F.to_date(started).alias("period"),
            pack(_fact_flags(), bits).alias("_flags"),
            *[c.alias(name) for name, c in {**values, **join_keys}.items()],
        )
    )
    packed = F.col("_flags")
    for _, join, flags in lookups:
        rows = join(rows, inputs)
        packed = packed.bitwiseOR(pack(flags, bits))
    narrow = rows.select(*KEYS, packed.alias("_flags"), *values)
    out = aggregate_packed(narrow, KEYS, "_flags", bits, metrics, _finish(amounts), few_rows_per_key=True)
    return out.withColumn("calc_date", day_literal(as_of))
