"""What the plans must look like whatever the data."""

import pytest

from workloads import queries as q
from workloads.standins import Tables

PLANNED = [n for n in q.QUERIES if not n.startswith(("sink_", "scan_", "table_", "balances"))]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_run(df):
    """The rows and the plan that adaptive execution ended with."""
    found = df.collect()
    return found, physical(df).split("== Initial Plan ==")[0]


#: With these a shuffled join has no broadcast to fall back on and splits a partition of little size.
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture
def tight(spark):
    q.tune(spark)
    for name, value in TIGHT.items():
        spark.conf.set(name, value)
    yield spark
    for name in TIGHT:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = physical(q.QUERIES[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_without_broadcasts_results_stay_the_same(spark, sf):
    """The shuffled form of every join, as past the broadcast limit, gives the same rows."""
    from workloads.compare import difference

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("cell_site_actual", "primary_region_monthly", "profile_data", "bundle_sales",
                     "fixed_line_sales", "porting_feed", "service_visits", "crm_contacts"):
            assert difference(spark, name, sf) is None, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hourly_usage_needs_one_exchange(spark, sf):
    t = Tables(q.tune(spark), sf)
    plan = physical(q.location.usage_hourly(t["det_layer"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_region_usage_counts_days_without_a_second_exchange(spark, sf):
    t = Tables(q.tune(spark), sf)
    usage = q.folders.materialise(q.location.usage_hourly(t["det_layer"]), "usage")
    plan = physical(q.location.region_usage(usage, q._cells(t), q.BEFORE, 90))
    on_keys = [line for line in plan.splitlines() if "Exchange hashpartitioning(subs_key" in line]
    assert len(on_keys) == 1
    assert "PushedFilters: [IsNotNull(period), GreaterThanOrEqual(period,2024-01-02)" in plan


def test_profile_reads_only_needed_columns(spark, sf):
    t = Tables(q.tune(spark), sf)
    stored = Tables(spark, sf)
    stored["det_layer"] = q.folders.materialise(t["det_layer"], "det-layer")
    plan = q._profile(stored, ("topup",))._jdf.queryExecution().executedPlan().toString()
    assert "rounded_data_volume" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n.startswith(("subscriber_profile", "profile_"))])
def test_profile_fills_one_wide_buffer_at_a_time(spark, sf, name):
    """Narrow rows are exchanged and sorted by key; neither side of the exchange has a table of wide buffers."""
    _, plan = as_run(q.QUERIES[name](spark, sf))
    wide = [line.strip(" :+-") for line in plan.splitlines() if "Aggregate" in line and "[subs_key" in line]
    assert len(wide) == 1 and "SortAggregate" in wide[0] and "partial_" not in wide[0]
    assert plan.count("Exchange hashpartitioning(subs_key") == 1


def test_a_hot_key_and_null_keys_are_split_in_shuffled_lookups(tight, tmp_path):
    """A third of the fact on one key and a third on NULL, with a lookup too big to broadcast."""
    spark = tight
    spark.range(20000).selectExpr("id d", "id * 2 v").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    hot = "case id % 3 when 0 then 7 when 1 then null else id % 20000 end"
    fact = spark.range(0, 400000, 1, 16).selectExpr("id", f"{hot} k", "uuid() text")
    looked_up = q.joins.role_lookup(fact, dim, "d", {"k": {"v": "v"}})
    total = looked_up.selectExpr("count(*) n", "count(v) known", "sum(v) v", "max(text) t")
    row = total.collect()[0]
    assert "skew=true" in physical(total)
    keys = [7 if i % 3 == 0 else None if i % 3 == 1 else i % 20000 for i in range(400000)]
    known = [k for k in keys if k is not None]
    assert (row.n, row.known, row.v) == (400000, len(known), 2 * sum(known))


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_prior_record_spreads_a_key_by_blocks(spark, sf, limit):
    t = Tables(q.tune(spark), sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        orders = t["fmc_order_data"]
        reached = q.orders.reached_orders(orders, t["fmc_change_status_log"], q.orders.BUNDLE, *q.ORDERS)
        plan = physical(q.orders.with_prior_order(reached, orders))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    windows = [line for line in lines if line.startswith("Window") and "_order" in line]
    by_block = [line for line in windows if "_block" in line.split("], [")[1]]
    assert len(by_block) == 2 and len(windows) == 3  # blocks, blocks of blocks, and those


@pytest.mark.parametrize("other", ["uuid()", "'x'"], ids=["hot phone", "hot row key"])
def test_hot_candidates_and_row_keys_are_split_in_first_match(tight, tmp_path, other):
    """A third of the phones on one value and a third NULL; where the rows differ in nothing else, their key is as hot."""
    tight.range(20000).selectExpr("concat(' ', id) phone").write.parquet(str(tmp_path / "known"))
    hot = "case id % 3 when 0 then '7' when 1 then null else cast(id % 40000 as string) end"
    rows = tight.range(0, 300000, 1, 16).selectExpr("if(id % 3 = 0, null, id div 150000) k", f"{hot} a", f"{other} b", "uuid() text")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = tight.read.parquet(str(tmp_path / "rows"))
    found = q.joins.first_match(rows, "k", ["a", "b"], tight.read.parquet(str(tmp_path / "known")), "phone", "hit")
    total = found.selectExpr("count(*) n", "count(hit) hits", "count_if(hit = a) same", "max(text) t")
    (row,), plan = as_run(total)
    assert "skew=true" in plan
    hits = sum(i % 3 == 0 or (i % 3 == 2 and i % 40000 < 20000) for i in range(300000))
    assert (row.n, row.hits, row.same) == (300000, hits, hits)


def test_first_match_moves_whole_rows_at_most_once(tight, sf):
    found = q.QUERIES["fixed_line_sales"](tight, sf)
    _, plan = as_run(found)
    lines = plan.splitlines()
    whole = [i for i, line in enumerate(lines) if " Exchange hashpartitioning" in line and "sl_dealer_name" in "".join(lines[i + 1 : i + 3])]
    assert len(whole) <= 2  # for the semi join with the log, and for the first match


@pytest.mark.parametrize("name, log", [("bundle_sales", "lineitem"), ("tv_sales", "lineitem"), ("fixed_line_sales", "lineitem")])
@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_status_log_is_read_once(spark, sf, name, log, limit):
    """Both uses of what is derived from the log share its exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found, plan = as_run(q.QUERIES[name](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found and plan.count(f"{log}.parquet") == 1 and "Reused" in plan


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_only_orders_of_reached_logins_are_put_in_order(spark, sf, monkeypatch, limit):
    """What goes into the blocks and their windows are the reached logins' orders, whatever the join."""
    from martloom.operators import asof

    pools, whole = [], asof.prior_record
    monkeypatch.setattr(asof, "prior_record", lambda records, *rest: pools.append(records) or whole(records, *rest))
    t = Tables(q.tune(spark), sf)
    orders = t["fmc_order_data"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        reached = q.orders.reached_orders(orders, t["fmc_change_status_log"], q.orders.BUNDLE, *q.ORDERS).filter("id % 50 = 0")
        found = q.orders.with_prior_order(reached, orders).collect()
        (pool,) = pools
        logins = {r.login_fttb for r in found}
        wanted = orders.filter(orders["login_fttb"].isin(*logins)).count()
        assert 0 < pool.count() == wanted < orders.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_planning_a_mart_starts_no_job(spark, sf):
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    q.QUERIES["scan_parquet"](spark, sf).schema
    spark.sparkContext.setJobGroup(group, group)
    try:
        t = Tables(q.tune(spark), sf)
        for name in ("lineitem", "orders", "part", "nation", "region", "supplier"):
            t[name]  # reading a footer for the schema is a job of Spark's own
        before = len(tracker.getJobIdsForGroup(group))
        q._region_usage(t, 30)._jdf.queryExecution().executedPlan()
        assert len(tracker.getJobIdsForGroup(group)) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
