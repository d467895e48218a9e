"""Cell-site dimension: where every (lac, cell) is and which technology it runs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.ranking import latest_per_key, newest

# Sector technologies and states that count.
SECTOR_KEYED = ("2G", "3G")
STATION_KEYED = "4G"
LIVE_STATES = ("test", "active")


def cell_site_actual(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (lac, cell_id); of several sites the newest in service wins.

    2G and 3G sectors are known by their own cell id, 4G sectors by their station's
    ``enodeb_id``. The two groups only differ in that column, so they are one pass
    over the inventory instead of a union of two nine-table joins.
    """
    sectors = (
        inputs["dir_sector"]
        .filter(
            F.col("cell_nettype").isin(*SECTOR_KEYED, STATION_KEYED)
            & F.col("cell_status").isin(*LIVE_STATES)
        )
        .select("id_bts", "lac_tac", "cell_id", "cell_nettype")
    )
    sites = (
        inputs["dir_sites"]
        .select("site_id", F.col("addr_id_city").alias("id_city"))
        .join(inputs["dir_city"], "id_city")
        .join(inputs["dir_city_type"], "id_city_type")
        .join(inputs["dir_area"], "id_area")
        .join(inputs["dir_region"], "id_region")
        .select("site_id", "name_region", "area_name", "city_name", "city_type_name")
    )
    stations = (
        inputs["dir_bts"]
        .join(inputs["dir_btsstatus"].select("id_btsstatus"), "id_btsstatus")
        .join(inputs["dir_btstype"].select("id_btstype"), "id_btstype")
        .select("id_bts", "site_id", "enodeb_id", "inservice_date")
    )
    placed = (
        sectors.join(stations, "id_bts")
        .join(sites, "site_id")
        .select(
            F.col("name_region").alias("region"),
            F.col("area_name").alias("district"),
            F.col("city_name").alias("city"),
            F.col("city_type_name").alias("city_type"),
            F.col("lac_tac").cast("bigint").alias("lac"),
            F.when(F.col("cell_nettype") == STATION_KEYED, F.col("enodeb_id"))
            .otherwise(F.col("cell_id"))
            .cast("bigint")
            .alias("cell_id"),
            "cell_nettype",
            "inservice_date",
            "id_bts",
        )
    )
    current = latest_per_key(
        placed, ["lac", "cell_id"], newest("inservice_date", "id_bts", "cell_nettype")
    )
    return current.drop("inservice_date", "id_bts")
