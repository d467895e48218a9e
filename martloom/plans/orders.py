"""Sales feeds from orders and their status logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import between_times
from martloom.functions.text import cut
from martloom.operators.asof import with_prior
from martloom.operators.joins import first_match, left_join_where, valid_on
from martloom.operators.transitions import one_per_moment, status_transitions

_ORDER_COLUMNS = [
    "login_fttb",
    "ban",
    "fttb_subscriber_type",
    "fmc_type_id",
    "phone1",
    "phone2",
    "phone3",
    "user_id",
    "sl_dealer_cd",
    "sl_dealer_name",
    "mon_dealer_cd",
]
_PRIOR = {
    "prev_req_id": "id",
    "prev_req_status": "order_status_id",
    "prev_fmc_req_type": "fmc_type_id",
}


@dataclass(frozen=True)
class SaleRule:
    """Which orders make a sale.

    ``types`` reaching one of ``statuses`` count; an order counts as new when its
    login has no earlier order (``new_types``), as an upgrade when it is of
    ``upgrade_to`` after ``upgrade_from``, and as a repeat after a closed order
    of the same type.
    """

    types: tuple[str, ...]
    statuses: tuple[int, ...]
    new_types: tuple[str, ...]
    upgrade_to: str
    upgrade_from: str
    closed_status: int = 4


# Order types and status codes of the two products.
BUNDLE = SaleRule(("2", "4"), (414, 14), ("2", "4"), "4", "3")
TV = SaleRule(("3",), (408, 9), ("3", "4"), "4", "2")


def reached_orders(orders: DataFrame, log: DataFrame, rule: SaleRule, lo, hi) -> DataFrame:
    """Orders of the rule's types with each moment in ``[lo, hi)`` they reached a status.

    One row per order and moment. The moments are found and deduplicated first, on
    three columns, and only then joined with the orders. A status is never NULL; saying so keeps
    all three columns where only the logins are wanted, so that both uses of the moments
    share one exchange and the log is read once.
    """
    moments = one_per_moment(
        status_transitions(
            orders,
            F.col("order_status_id").isin(*rule.statuses)
            & F.col("pre_order_status_id").isNull()
            & between_times(F.col("order_status_date"), lo, hi),
            ("id", "order_status_id", "order_status_date"),
            log,
            F.col("pre_order_status_id").isin(*rule.statuses)
            & between_times(F.col("pre_order_status_date"), lo, hi),
            ("fmc_order_id", "pre_order_status_id", "pre_order_status_date"),
        )
    ).filter(F.col("status").isNotNull())
    eligible = orders.filter(
        F.col("fmc_type_id").isin(*rule.types) & F.col("login_fttb").isNotNull()
    ).select("id", *_ORDER_COLUMNS)
    return eligible.join(moments, "id").select(
        "id",
        F.col("status").alias("order_status_id"),
        F.col("status_date").alias("order_status_date"),
        *_ORDER_COLUMNS,
    )


def with_prior_order(reached: DataFrame, orders: DataFrame) -> DataFrame:
    """Add the login's latest earlier order: its id, status and type. Only reached logins' orders are looked at."""
    pool = orders.select("id", F.col("login_fttb"), "order_status_id", "fmc_type_id")
    return with_prior(reached, pool, "login_fttb", "id", _PRIOR)


def is_sale(rule: SaleRule) -> Column:
    kind, before = F.col("fmc_type_id"), F.col("prev_fmc_req_type")
    return (
        (kind.isin(*rule.new_types) & before.isNull())
        | ((kind == rule.upgrade_to) & (before == rule.upgrade_from))
        | ((kind == before) & (F.col("prev_req_status") == rule.closed_status))
    )


def order_sales(orders: DataFrame, log: DataFrame, rule: SaleRule, lo, hi) -> DataFrame:
    return with_prior_order(reached_orders(orders, log, rule, lo, hi), orders).filter(is_sale(rule))


def bundle_sales(inputs: Mapping[str, DataFrame], as_of: date | str, lo, hi) -> DataFrame:
    """Bundle sales reached in ``[lo, hi)`` with the order's main number valid on ``as_of``."""
    sales = order_sales(inputs["fmc_order_data"], inputs["fmc_change_status_log"], BUNDLE, lo, hi)
    numbers = inputs["fmc_gsm"].withColumnRenamed("fmc_order_id", "id")
    main = (F.col("sign_main_gsm") == "1") & valid_on(
        F.col("expiration_date"), as_of, last_day_counts=False, open_ended=True
    )
    return left_join_where(sales, numbers, ["id"], main).drop("expiration_date")


def tv_sales(inputs: Mapping[str, DataFrame], lo, hi) -> DataFrame:
    return order_sales(inputs["fmc_order_data"], inputs["fmc_change_status_log"], TV, lo, hi)


def connected_orders(
    orders: DataFrame, log: DataFrame, lo, hi, status: int = 1
) -> DataFrame:
    """Orders that reached ``status`` in ``[lo, hi)``, now or in the log: a semi join.

    The ids are made distinct on the join's own key, which needs no further exchange
    and collapses an id the log repeats before it is sent.
    """
    reached = status_transitions(
        orders,
        (F.col("order_status_id") == status) & between_times(F.col("order_status_date"), lo, hi),
        ("id", "order_status_id", "order_status_date"),
        log,
        (F.col("pre_order_status_id") == status)
        & between_times(F.col("pre_order_status_date"), lo, hi),
        ("suz_order_data_id", "pre_order_status_id", "pre_order_status_date"),
    )
    return orders.join(reached.select("id").distinct(), "id", "left_semi")


def fixed_line_sales(
    inputs: Mapping[str, DataFrame],
    lo,
    hi,
    candidates: Sequence[str] = ("phone", "phone2", "phone3"),
) -> DataFrame:
    """Orders connected in ``[lo, hi)`` with the first candidate phone that is a subscriber."""
    sold = connected_orders(inputs["suz_order_data"], inputs["change_order_status_log"], lo, hi)
    known = first_match(sold, "id", candidates, inputs["subscriber"], "subscriber_no", "_known")
    return known.select(
        "id",
        "login",
        "ban",
        F.col("_known").alias("phone"),
        "connection_type",
        "sl_dealer_cd",
        "sl_dealer_name",
        "user_id",
        "order_status_id",
        "pre_order_status_id",
        cut(F.col("phone"), 10).alias("subs_contact_num"),
    )
