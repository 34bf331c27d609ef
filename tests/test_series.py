"""Series operators: quirks on hand-made frames, and blocked against plain windows."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statmart.operators import series as s
from statmart.operators import stats

D = date(2024, 1, 1)


def schedule(spark):
    days = [0, 1, 3, 4, 10]
    return spark.createDataFrame([("a", i, D + timedelta(d)) for i, d in enumerate(days)], "k string, id int, d date")


def test_schedule(spark):
    df = s.days_since_prev(schedule(spark), "gap", "d", ["k"], ["d", "id"])
    df = df.withColumn("b2b", s.is_back_to_back("gap"))
    df = s.count_in_trailing_days(df, {"n4": 3, "n6": 5}, ["k"], "d")
    got = [tuple(r) for r in df.orderBy("id").select("gap", "b2b", "n4", "n6").collect()]
    assert got == [(None, 0, 1, 1), (1, 1, 2, 2), (2, 0, 3, 3), (1, 1, 3, 4), (6, 0, 1, 1)]
    pre = s.count_in_trailing_days(schedule(spark), {"n4": 3}, ["k"], "d", pre_aggregate=True)
    assert [r[0] for r in pre.orderBy("id").select("n4").collect()] == [1, 2, 3, 3, 1]


def test_trailing_days_without_key_counts_zero(spark):
    df = spark.createDataFrame([(None, D), ("a", None), ("a", D)], "k string, d date")
    for pre in (False, True):
        got = s.count_in_trailing_days(df, {"n": 3}, ["k"], "d", pre_aggregate=pre)
        assert sorted((str(r.k), str(r.d), r.n) for r in got.collect()) == [("None", str(D), 0), ("a", str(D), 1), ("a", "None", 0)]


def hot(spark, n=400):
    """One key holds most rows; days are uneven and some values are unknown."""
    rows = [("hot" if i % 5 else f"k{i % 7}", i, D + timedelta((i * i) % 23), None if i % 11 == 0 else float(i % 13), i % 3) for i in range(n)]
    rows += [(None, n + i, D + timedelta(i), 1.0, 1) for i in range(5)]
    return spark.createDataFrame(rows, "k string, id int, d date, v double, f int").repartition(4)


@pytest.mark.parametrize("unit", ["day", "week", "month"])
def test_blocked_equals_plain(spark, rows, unit):
    df, keys, order = hot(spark), ["k"], ["d", "id"]
    block = s.time_block("d", unit)
    cond = F.col("f") == 1

    def build(b):
        x = s.expanding_avg(df, {"e": "v"}, keys, order, cond=cond, block=b)
        x = s.sequence_number(x, "n", keys, order, block=b)
        x = s.running_count(x, {"before": cond}, keys, order, block=b, prior_only=True)
        x = s.rolling_avg(x, {"r": "v"}, 10, keys, order, "rn", block=b)
        x = s.rolling_rate(x, "rate", cond, 10, keys, order, block=b)
        x = s.next_id(x, "nx", "id", keys, order, block=b)
        x = s.days_since_prev(x, "gap", "d", keys, order, block=b)
        x = s.last_active_flag(x, "last", cond, keys, order, whole=b is None)
        return rows(x, "id", F.round("e", 9), "n", "before", F.round("r", 9), "rn", "rate", "nx", "gap", "last")

    assert build(block) == build(None)


def test_blocks_spread_a_hot_key(spark):
    """The blocked window partitions by (key, block), not by key alone."""
    df = s.sequence_number(hot(spark), "n", ["k"], ["d", "id"], block=s.time_block("d", "day"))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "hashpartitioning(k" in plan and "__block" in plan.split("Window", 1)[1]


def test_last_active_and_latest(spark, rows):
    df = spark.createDataFrame([("a", 1, D, 1), ("a", 2, D + timedelta(1), 0), ("b", 3, D, 0)], "k string, id int, d date, f int")
    flagged = s.last_active_flag(df, "o", F.col("f") == 1, ["k"], ["d", "id"])
    assert rows(flagged, "id", "o") == [(1, 1), (2, 0), (3, 0)]
    nulls = spark.createDataFrame([("a", 1, None), ("a", 2, D), ("b", 3, None)], "k string, id int, d date")
    assert rows(s.latest_per(nulls, ["k"], ["d"], ["id"]), "id") == [(2,), (3,)]


def test_zscore_edges(spark, rows):
    df = spark.createDataFrame([("c", 1, 5.0), ("c", 2, 5.0), ("s", 3, 1.0), ("n", 4, None), ("n", 5, 1.0), ("n", 6, 3.0), (None, 7, 1.0), (None, 8, 3.0)], "p string, id int, x double")
    z = {r.id: r.z for r in stats.zscores(df, {"z": "x"}, ["p"]).collect()}
    assert z[1] is None and z[3] is None and z[4] is None
    assert z[5] == pytest.approx(-z[6]) == pytest.approx(-0.7071067811865475) == pytest.approx(z[7])


def test_zscores_have_mean_0_and_deviation_1(spark):
    z = stats.zscores(hot(spark).withColumn("one", F.lit(1)), {"z": "v"}, ["one"])
    m, sd = z.agg(F.avg("z"), F.stddev_samp("z")).first()
    assert m == pytest.approx(0, abs=1e-9) and sd == pytest.approx(1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.sampled_from([0.0, -1.5, 2.0, 1e9, 1e-9, -3e5, 7.25])), min_size=1, max_size=40))
def test_rank_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r.id: (r.rk, r.dn) for r in stats.rank_desc(df, "v", rank="rk", dense="dn").collect()}
    known = [v for v in values if v is not None]
    for i, v in enumerate(values):
        want = (None, None) if v is None else (1 + sum(x > v for x in known), 1 + len({x for x in known if x > v}))
        assert got[i] == want


def test_rank_top_keeps_global_ranks(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0), (4, None), (5, 9.0)], "id int, v double")
    assert rows(stats.rank_top(df, "v", 3, "r", ["id"]), "r", "id") == [(1, 5), (2, 1), (2, 2)]


def test_leaders_tie_goes_to_smallest_id_and_unknown_is_null(spark, rows):
    df = spark.createDataFrame([("w", 2, 5.0, None), ("w", 1, 5.0, None), ("w", 3, 1.0, None)], "g string, id int, a double, b double")
    assert rows(stats.leaders(df, {"A": "a", "B": "b"}, ["g"], ["id"], ["id"]), "category", "id") == [("A", 1), ("B", None)]


def test_rank_of_nan_and_infinity(spark):
    values = [float("nan"), float("inf"), 1.7e308, 2.0, 2.0, -1.0, float("-inf"), None]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: (r.r, r.d) for r in stats.rank_desc(df, "v", rank="r", dense="d").collect()}
    assert got == {0: (1, 1), 1: (2, 2), 2: (3, 3), 3: (4, 4), 4: (4, 4), 5: (6, 5), 6: (7, 6), 7: (None, None)}
