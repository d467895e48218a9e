"""Operators on small hand-made frames, most of them against brute force."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import classify, dates, text
from martloom.operators import asof, horizons, joins, kpi, ranking, transitions
from martloom.sinks import folders


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- ranking ----------------------------------------------------------------


def test_latest_per_key_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 1, 11), ("a", None, 99), ("b", None, 1), (None, 5, 2), (None, 6, 3)],
        "k string, v int, id int",
    )
    got = ranking.latest_per_key(df, ["k"], ranking.newest("v", "id"))
    assert rows(got, "k", "v", "id") == sorted([("a", 1, 11), ("b", None, 1), (None, 6, 3)], key=repr)


def test_ranking_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert ranking.top_k(df, ["k"], ranking.newest("v"), 2).count() == 0


def test_current_previous_with_one_record(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (2, "z", 2), (2, "w", 0)], "k int, c string, v int")
    got = ranking.current_previous(df, ["k"], ranking.newest("v"), {"now": "c"}, {"before": "c"})
    assert rows(got, "k", "now", "before") == [(1, "x", None), (2, "z", "y")]


def test_top_k_limits_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = ranking.top_k(df, ["k"], ranking.newest("id"), 2)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below


# --- joins ------------------------------------------------------------------


def test_unique_lookup_drops_duplicates_and_null_keys(spark):
    dim = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 0), (2, "c", 5), (None, "d", 1)], "k int, name string, n int"
    )
    assert rows(joins.unique_lookup(dim, ["k"], "name", "n"), "k", "name", "n") == [(1, "b", 0), (2, "c", 5)]
    assert rows(joins.unique_lookup(dim, ["k"]), "k") == [(1,), (2,)]


def test_left_join_where_keeps_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    right = spark.createDataFrame([(1, "1"), (2, "0")], "id int, main string")
    got = joins.left_join_where(left, right, ["id"], F.col("main") == "1")
    assert rows(got, "id", "main") == [(1, "1"), (2, None), (3, None)]


def test_role_lookup_with_duplicate_dimension_rows(spark):
    fact = spark.createDataFrame([(1, 1, 2), (2, 2, None), (3, 9, 1)], "id int, donor int, recipient int")
    dim = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "op int, code string")
    got = joins.role_lookup(fact, dim, "op", {"donor": {"code": "d"}, "recipient": {"code": "r"}})
    assert rows(got, "id", "d", "r") == [(1, "A", "B"), (2, "B", None), (3, None, "A")]


def test_first_match_prefers_earlier_candidates(spark):
    known = spark.createDataFrame([("10 ",), ("20",), ("20",), ("30",)], "n string")
    df = spark.createDataFrame(
        [(1, " 10", "20", "30"), (2, "99", "20", "30"), (3, None, "98", "30"), (4, None, None, "97")],
        "id int, a string, b string, c string",
    )
    got = joins.first_match(df, "id", ["a", "b", "c"], known, "n", "hit")
    assert rows(got, "id", "hit") == [(1, "10"), (2, "20"), (3, "30"), (4, None)]


def test_first_match_keeps_every_row_whatever_its_key(spark):
    known = spark.createDataFrame([("10",), ("20",)], "n string")
    data = [(None, "10"), (None, "20"), (None, "99"), (1, "10"), (1, "20"), (2, "20"), (2, "20")]
    df = spark.createDataFrame(data, "id int, a string")
    got = [tuple(r) for r in joins.first_match(df, "id", ["a"], known, "n", "hit").collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, a, None if a == "99" else a)) for i, a in data)


@pytest.mark.parametrize("last_day, open_ended, expected", [
    (True, True, [1, 2, 4]), (False, True, [2, 4]), (True, False, [1, 2]), (False, False, [2]),
])
def test_valid_on(spark, last_day, open_ended, expected):
    df = spark.createDataFrame(
        [(1, date(2024, 4, 1)), (2, date(2024, 4, 2)), (3, date(2024, 3, 31)), (4, None)], "id int, td date"
    )
    keep = joins.valid_on(F.col("td"), "2024-04-01", last_day_counts=last_day, open_ended=open_ended)
    assert [r.id for r in df.filter(keep).orderBy("id").collect()] == expected


# --- latest earlier record --------------------------------------------------------


@pytest.mark.parametrize("block", [32, 1000, 1 << 20])
def test_prior_record_against_brute_force_with_a_hot_key(spark, block):
    rng = random.Random(block)
    ids = rng.sample(range(-200, 3000), 600)
    data = [(i, None if i % 11 == 0 else ("hot" if i % 3 else f"k{i % 40}"), i % 5) for i in ids]
    df = spark.createDataFrame(data, "id long, key string, status int")
    got = asof.prior_record(df, "key", "id", {"prev_id": "id", "prev_status": "status"}, block)
    expected = []
    for i, key, _ in data:
        if key is None:
            continue
        before = max(((j, s) for j, k, s in data if k == key and j < i), default=(None, None))
        expected.append((i, *before))
    assert rows(got, "id", "prev_id", "prev_status") == sorted(expected, key=repr)


def test_prior_record_keeps_null_payload_of_the_prior(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "a", "z")], "id long, key string, v string")
    got = asof.prior_record(df, "key", "id", {"prev_id": "id", "prev": "v"}, 64)
    assert rows(got, "id", "prev_id", "prev") == [(1, None, None), (2, 1, "x"), (3, 2, None)]


def test_with_prior_keeps_repeated_left_rows(spark):
    records = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, key string")
    left = spark.createDataFrame([(2, "a", 10), (2, "a", 20), (3, "b", 10)], "id long, key string, t int")
    got = asof.with_prior(left, records, "key", "id", {"prev": "id"})
    assert rows(got, "id", "t", "prev") == sorted([(2, 10, 1), (2, 20, 1), (3, 10, None)], key=repr)


# --- transitions ------------------------------------------------------------


def test_transitions_keep_repeats_until_one_per_moment(spark):
    day = datetime(2024, 1, 1)
    current = spark.createDataFrame([(1, 14, day)], "id long, s int, t timestamp_ntz")
    log = spark.createDataFrame([(1, 14, day), (1, 414, day), (2, 9, day)], "oid long, s int, t timestamp_ntz")
    both = transitions.status_transitions(
        current, F.col("s").isin(14, 414), ("id", "s", "t"), log, F.col("s").isin(14, 414), ("oid", "s", "t")
    )
    assert both.count() == 3
    assert rows(transitions.one_per_moment(both), "id", "status") == [(1, 414)]


# --- windows of days ----------------------------------------------------------


def test_trailing_edges(spark):
    days = [date(2024, 3, 24), date(2024, 3, 25), date(2024, 3, 31), date(2024, 4, 1)]
    df = spark.createDataFrame([(datetime(d.year, d.month, d.day, 23, 59, 59), d) for d in days], "t timestamp_ntz, d date")
    for column in ("t", "d"):
        before = df.filter(dates.trailing(F.col(column), "2024-04-01", 7)).select("d")
        assert [r.d for r in before.orderBy("d").collect()] == days[1:3]
        upto = df.filter(dates.trailing(F.col(column), "2024-04-01", 7, inclusive=True)).select("d")
        assert [r.d for r in upto.orderBy("d").collect()] == days[2:]


@pytest.mark.parametrize("span", [7, 30, 63, 64, 90, 130])
def test_distinct_days_against_brute_force(spark, span):
    rng = random.Random(span)
    data = [(rng.choice("aab"), rng.randrange(span)) for _ in range(400)] + [("c", 0), ("c", span - 1)]
    df = spark.createDataFrame(data, "k string, age int")
    marked = df.groupBy("k").agg(*horizons.day_marks(F.col("age"), span))
    windows = sorted({1, 5, span // 2, span})
    got = marked.select("k", *[horizons.days_seen(span, w).alias(f"d{w}") for w in windows])
    expected = [
        (k, *[len({a for kk, a in data if kk == k and a < w}) for w in windows]) for k in "abc"
    ]
    assert rows(got, "k", *[f"d{w}" for w in windows]) == expected


# --- conditional metrics --------------------------------------------------------


def test_metrics_else_values_and_unknown_flags(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, None, 7), (2, None, 3), (3, "x", -4)], "k int, f string, v int")
    got = kpi.conditional_metrics(
        df, ["k"], {"x": F.col("f") == "x"}, {"v": F.col("v")},
        [kpi.Metric("t", "total", "v", ("x",)), kpi.Metric("c", "count", None, ("x",)),
         kpi.Metric("p", "peak", "v", ("x",)), kpi.Metric("l", "latest", "v", ("x",))],
    )
    # A peak is the greatest of the qualifying values and, for other rows, 0: in group 3
    # every row qualifies, so it is negative.
    assert rows(got, "k", "t", "c", "p", "l") == [(1, 5, 1, 5, 5), (2, 0, 0, 0, None), (3, -4, 1, -4, -4)]


def test_metrics_are_the_same_for_few_rows_per_key(spark):
    """NULL keys are a group of their own, whatever the order and the number of a key's rows."""
    data = [(k, i % 2 or None, i % 4, None if i % 5 == 0 else i - 50) for i in range(200) for k in (-7, None, i)]
    df = spark.createDataFrame(data, "a int, b int, flags long, v long").repartition(5)
    metrics = [kpi.Metric(f"{how}_{'_'.join(when)}", how, None if how == "count" else "v", when)
               for how in ("total", "count", "peak", "latest") for when in (("x",), ("x", "y"))]
    names = ["a", "b", *[m.name for m in metrics]]
    one, other = (
        kpi.aggregate_packed(df, ["a", "b"], "flags", {"x": 1, "y": 2}, metrics, few_rows_per_key=few) for few in (False, True)
    )
    assert other.columns == one.columns == names and other.count() == 204
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_sums_that_are_zero_or_unknown_have_the_type_of_others(spark):
    df = spark.createDataFrame([(1, "0.0"), (2, None), (3, "-1.5"), (3, "1.5"), (4, "90")], "k int, t string")
    df = df.select("k", F.col("t").cast("decimal(18,1)").alias("a"))
    amount = kpi.exact(df, F.col("a"))
    total = F.sum(amount.units)
    got = df.groupBy("k").agg(amount.total(total).alias("s"), amount.per(total, 60).alias("m"))
    assert dict(got.dtypes) == {"k": "int", "s": "decimal(28,1)", "m": "double"}
    assert rows(got, "k", "s", "m") == [(1, 0, 0.0), (2, None, None), (3, 0, 0.0), (4, 90, 1.5)]


@pytest.mark.parametrize("kind, values, total", [
    ("decimal(18,2)", ["0.10", "-12345678901234.57"], "-12345678901234.47"),
    ("decimal(18,4)", ["0.0199", "0.0002"], "0.0201"),
    ("decimal(18,1)", ["30.9", "29.9"], "60.8"),
    ("decimal(30,9)", ["0.000000001", "123456789012345678901.5"], "123456789012345678901.500000001"),
    ("double", ["0.29", "1.15"], "1.44"),
    ("int", ["2000000000", "2000000000"], "4000000000"),
])
def test_amounts_of_any_scale_are_exact(spark, kind, values, total):
    df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast(kind).alias("a"))
    amount = kpi.exact(df, F.col("a"))
    row = df.agg(amount.total(F.sum(amount.units)).alias("s"), amount.per(F.sum(amount.units), 60).alias("m")).first()
    assert Decimal(row.s) == Decimal(total)
    assert row.m == float(total) / 60


def test_unique_lookup_has_one_rule_for_null_payloads(spark):
    dim = spark.createDataFrame([(1, None, 1), (1, 5, None), (2, None, None), (3, 4, None), (3, 4, 2)], "k int, a int, b int")
    assert rows(joins.unique_lookup(dim, ["k"], "a"), "k", "a") == [(1, 5), (2, None), (3, 4)]
    assert rows(joins.unique_lookup(dim, ["k"], "a", "b"), "k", "a", "b") == [(1, 5, None), (2, None, None), (3, 4, 2)]


def test_separator_is_one_literal_character(spark):
    df = spark.createDataFrame([("a\\b]c^d",)], "s string")
    assert [df.select(text.first_part(F.col("s"), c)).first()[0] for c in "\\]^"] == ["a", "a\\b", "a\\b]c"]
    with pytest.raises(ValueError):
        text.first_part(F.col("s"), "ab")


# --- scalar functions -----------------------------------------------------------


def test_clean_id(spark):
    df = spark.createDataFrame([(" 12",), ("a3-4",), ("",), ("xyz",), (None,), ("9" * 25,)], "s string")
    assert [r.i for r in df.select(text.clean_id(F.col("s")).alias("i")).collect()] == [12, 34, None, None, None, None]


def test_equivalent_rate_of_unknown_technology(spark):
    df = spark.createDataFrame([("2G",), ("3G",), ("4G",), (None,), ("5G",)], "n string")
    got = [r.r for r in df.select(classify.equivalent_rate(F.col("n")).alias("r")).collect()]
    assert got == [20.0, 21.4, 0.0, 20.0, None]


def test_resolve_as_of():
    today = date(2024, 3, 15)
    assert dates.resolve_as_of("sysdate", today) == today
    assert dates.resolve_as_of("sysmonth", today) == date(2024, 2, 1)
    assert dates.resolve_as_of("sysmonth", date(2024, 1, 31)) == date(2023, 12, 1)
    assert dates.resolve_as_of("2020-02-29", today) == date(2020, 2, 29)


# --- shared folders -----------------------------------------------------------


def test_a_local_warehouse_is_an_error_on_a_cluster(spark):
    assert folders.shared_folder(spark)
    for master in ("local", "local[4]", "local-cluster[2,1,1024]"):
        folders.require_shared("file", master)
    for master in ("yarn", "spark://host:7077", "k8s://host"):
        folders.require_shared("hdfs", master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            folders.require_shared("file", master)


def test_removed_folders_are_gone(spark):
    path = folders.fresh_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    folders.remove(spark, path)
    spark.range(4).write.parquet(path)  # an error if it were still there
    assert spark.read.parquet(path).count() == 4
