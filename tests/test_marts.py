"""Invariants of the marts and the repaired defects."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martloom.plans import cells, contacts, location, orders, price_plan, profile, recharge
from martloom.sinks import folders, tables
from martloom.sources import readers
from workloads import queries as q
from workloads.standins import Tables


@pytest.fixture(scope="module")
def t(spark, sf):
    return Tables(q.tune(spark), sf)


@pytest.fixture(scope="module")
def usage(t):
    return folders.materialise(location.usage_hourly(t["det_layer"]), "usage")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cells_are_unique(t):
    result = q._cells(t)
    assert result.count() == result.select("lac", "cell_id").distinct().count()


def test_one_first_rank_per_subscriber(t, usage):
    ranks = location.rank_regions(location.region_usage(usage, q._cells(t), q.BEFORE, 90))
    per_group = ranks.groupBy("subs_key", "ban_key").agg(
        F.count_if(F.col("rn") == 1).alias("first"), F.max("rn").alias("last"), F.count("*").alias("n")
    )
    assert per_group.filter((F.col("first") != 1) | (F.col("last") != F.col("n"))).count() == 0


def test_region_totals_equal_usage_totals(t, usage):
    by_region = location.region_usage(usage, q._cells(t), q.BEFORE, 90)
    inside = usage.filter(F.col("period") >= F.lit("2024-01-02").cast("date"))
    for column in ("call_out_amt", "call_in_amt"):
        assert by_region.agg(F.sum(column)).first()[0] == inside.agg(F.sum(column)).first()[0]


def test_all_horizons_equal_single_windows(t, usage):
    together = location.usage_by_region(usage, q._cells(t), q.BEFORE)
    for days in (7, 30, 90):
        single = location.region_usage(usage, q._cells(t), q.BEFORE, days)
        assert same(together.filter(F.col("horizon") == days).drop("horizon"), single)


def test_recharge_horizons_equal_single_windows(t):
    together = recharge.recharge_by_source(t["det_layer"], t["dim_mtr_classification"], q.ON)
    for days in (7, 30, 90):
        single = recharge.recharge_source(t["det_layer"], t["dim_mtr_classification"], q.ON, days)
        assert same(together.filter(F.col("horizon") == days).drop("horizon"), single)


def test_profile_has_all_metrics_and_roaming_adds_up(t):
    assert sum(len(f) for f in profile.FAMILIES.values()) == 74
    result = q.QUERIES["profile_arpu"](t.spark, t.folder)
    parts = [F.col(f"subs_roam_{p}_arpu_daily") for p in ("voice", "smsmms", "gprs", "content")]
    off = result.filter(F.col("subs_roam_arpu_daily") != parts[0] + parts[1] + parts[2] + parts[3])
    assert off.count() == 0


def test_bundle_sales_are_unique(t):
    sales = orders.bundle_sales(t, "2024-04-01", *q.ORDERS)
    assert sales.count() == sales.select("id", "order_status_date").distinct().count()


def test_days_are_counted_from_dates(t, usage):
    """Distinct days are those of the period itself, never a failed cast of its text."""
    result = location.region_usage(usage, q._cells(t), q.BEFORE, 30)
    assert result.filter((F.col("uniq_days_amt") < 1) | (F.col("uniq_days_amt") > 30)).count() == 0
    assert result.filter(F.col("uniq_days_amt") > 1).count() > 0


def test_contacts_are_of_the_last_days(t):
    result = contacts.crm_contacts(t, q.CONTACTS_ON, outgoing="OUT", incoming="IN")
    ends = result.agg(F.min("interactionendtime"), F.max("interactionendtime")).first()
    assert datetime(2024, 1, 20) < ends[0] and ends[1] < datetime(2024, 1, 31, 1)


def test_ranking_is_deterministic_under_ties(spark):
    usage = spark.createDataFrame(
        [("b",), ("a",), ("c",)], "region string"
    ).selectExpr(
        "date'2024-04-01' calc_date", "1 subs_key", "1 ban_key", "region", "3 uniq_days_amt",
        "1.0D voice_gprs_mrg_mb", "1 call_out_amt", "1 call_in_amt",
    )
    got = location.rank_regions(usage).orderBy("rn").collect()
    assert [r.region for r in got] == ["a", "b", "c"]


def test_duplicate_service_rows_do_not_multiply_revenue(t):
    plain = q._profile(t, ("arpu",)).agg(F.sum("subs_arpu_daily")).first()[0]
    doubled = Tables(t.spark, t.folder)
    service = t["dim_business_service"]
    doubled["dim_business_service"] = service.unionAll(service)
    assert q._profile(doubled, ("arpu",)).agg(F.sum("subs_arpu_daily")).first()[0] == plain


def test_price_plan_of_a_rerun_ignores_later_agreements(t):
    early = price_plan.price_plan_current_prev(t, date(1996, 1, 1))
    assert early.agg(F.max("price_plan_change_date")).first()[0] < datetime(1996, 1, 2)


def test_empty_inputs(spark, t):
    none = {n: t[n].limit(0) for n in ("dir_sites", "dir_city", "dir_city_type", "dir_area", "dir_region",
                                       "dir_bts", "dir_btsstatus", "dir_btstype", "dir_sector")}
    assert cells.cell_site_actual(none).count() == 0
    assert location.usage_hourly(t["det_layer"].limit(0)).count() == 0


# --- storage ----------------------------------------------------------------


def test_month_and_day_folder_belong_together(spark, tmp_path):
    df = spark.range(3)
    folders.write_dated_folder(df, str(tmp_path), date(2024, 2, 28), month_folder=True)
    assert (tmp_path / "02-2024" / "28022024").is_dir()
    assert readers.read_snapshot_folder(spark, str(tmp_path), date(2024, 3, 1), -2, month_folder=True).count() == 3
    assert readers.dataset_path("/r/", "s", "n", "x.parq", date(2024, 2, 28)) == "/r/s/n/02-2024/x.parq"


def test_write_refuses_an_existing_folder(spark, tmp_path):
    folders.write_dated_folder(spark.range(1), str(tmp_path), "2024-01-01")
    with pytest.raises(Exception, match="(?i)already exists"):
        folders.write_dated_folder(spark.range(1), str(tmp_path), "2024-01-01")


def test_rewriting_a_day_keeps_the_others(spark, tmp_path):
    base = str(tmp_path / "d")
    for day in ("2024-01-01", "2024-01-02"):
        folders.overwrite_date(spark.range(5), base, day)
    for _ in range(2):
        folders.overwrite_date(spark.range(2), base, "2024-01-02")
    counts = {str(r.dt): r["count"] for r in readers.read_dated(spark, base).groupBy("dt").count().collect()}
    assert counts == {"2024-01-01": 5, "2024-01-02": 2}


def test_dated_read_prunes_partitions(spark, tmp_path):
    base = str(tmp_path / "d")
    folders.overwrite_dates(spark.range(4).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) dt"), base)
    one = readers.read_snapshot(spark, base, "2024-01-05", -3)
    assert one.count() == 1 and one.dtypes == [("id", "bigint"), ("dt", "date")]
    assert all("dt=2024-01-02" in name for name in one.inputFiles())
    assert "InMemoryFileIndex(1 paths)" in one._jdf.queryExecution().executedPlan().toString()
    assert readers.read_snapshot(spark, base, "2025-01-05", -3).count() == 0
    plan = readers.read_dated(spark, base, "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_rerun_of_a_day_without_rows_empties_it(spark, tmp_path):
    base = str(tmp_path / "d")
    for day, n in (("2024-01-01", 5), ("2024-01-02", 2)):
        folders.overwrite_date(spark.range(n), base, day)
    folders.overwrite_date(spark.range(0), base, "2024-01-02")
    counts = {str(r.dt): r["count"] for r in readers.read_dated(spark, base).groupBy("dt").count().collect()}
    assert counts == {"2024-01-01": 5}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text("name;b;a\nx;2;1\n")
    got = readers.read_csv_dimension(spark, str(tmp_path / "c.csv"), ["a", "b"])
    assert [tuple(r) for r in got.collect()] == [("1", "2")]
    with pytest.raises(Exception, match="no_such"):
        readers.read_csv_dimension(spark, str(tmp_path / "c.csv"), ["no_such"])


def test_swap_keeps_the_old_partition_until_the_new_one_is_named(spark, tmp_path, monkeypatch):
    tables.create_external_table(spark, "t_swap", {"id": "bigint"}, {"dt": "date"}, str(tmp_path / "t"))
    tables.swap_partition(spark.range(3), "t_swap", "dt", "2024-01-01", str(tmp_path / "one"))

    def refuse(*_):
        raise AssertionError("a swap drops nothing")

    monkeypatch.setattr(tables, "drop_partition", refuse)
    tables.swap_partition(spark.range(7), "t_swap", "dt", "2024-01-01", str(tmp_path / "two"))
    assert spark.table("t_swap").count() == 7
    tables.swap_partition(spark.range(0), "t_swap", "dt", "2024-01-01", str(tmp_path / "none"))
    assert spark.table("t_swap").count() == 0
    spark.sql("drop table t_swap")


def test_owned_folders_are_removed(spark):
    path = folders.fresh_folder(spark, "owned")
    spark.range(1).write.parquet(path)
    folders.remove_owned()
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_table_helpers(spark, tmp_path):
    assert not tables.table_exists(spark, "no_such_table")
    tables.create_external_table(spark, "t_orc", {"id": "bigint"}, {"dt": "date"}, str(tmp_path / "t"), "orc")
    assert tables.table_exists(spark, "t_orc") and tables.table_format(spark, "t_orc") == "orc"
    tables.drop_partition(spark, "t_orc", "dt", "2024-01-01")
    tables.swap_partition(spark.range(3), "t_orc", "dt", "2024-01-01", str(tmp_path / "p"))
    assert spark.table("t_orc").count() == 3
    spark.sql("drop table t_orc")
