"""Carry states against whole windows, upserts by day, the versioned ingest, and the CSV reader at width."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from statmart.operators import carry, series, stats
from statmart.sources import daily as by_day
from statmart.sources import readers, writers
from statmart.sources.schemas import text_schema
from statmart.streaming import ingest

DAYS = [date(2024, 1, 1) + timedelta(d) for d in range(12)]


@pytest.fixture(scope="module")
def games(spark):
    """Series of many and few rows, some days with several, nulls in values, a key that is null."""
    rng = random.Random(4)
    rows = []
    for k in [*range(8), None]:
        for d in DAYS:
            for g in range(rng.choice([0, 0, 1, 1, 2, 5]) if k else 1):
                rows.append((k, d, f"{d:%d}{g}", rng.choice([None, 1.0, 2.5, 7.0]), rng.randrange(2)))
    return spark.createDataFrame(rows, "k long, day date, g string, v double, played int")


def memory(n=3):
    played = F.col("played") == 1
    return carry.Memory(["k"], ["day", "g"], {"m": F.when(played, F.col("v")), "share": F.col("played")}, ["v"], n, played)


def by_steps(games, borders, m):
    """The tables that a build in steps gives, each step from its own rows and the state before it."""
    before, outs = None, []
    for low, high in zip([date(2000, 1, 1), *borders], [*borders, date(2999, 1, 1)]):
        rows = games.filter((F.col("day") >= F.lit(low)) & (F.col("day") < F.lit(high)))
        means = carry.carried_means(rows, m, before)
        rolled = carry.carried_rolling(rows, m, {"r": "v"}, 4, before, "n")
        outs.append(means.join(rolled.select("k", "day", "g", "r", "n"), (means.k.eqNullSafe(rolled.k)) & (means.day == rolled.day) & (means.g == rolled.g)).select(means["*"], "r", "n"))
        after = carry.states(rows, m, before)
        last = after.agg(F.max("day")).first()[0]
        before = after.filter(F.col("day") == F.lit(last)).drop("day") if last else before
    return outs, before


@pytest.mark.parametrize("borders", [[], [date(2024, 1, 5)], [date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 10)]])
def test_steps_equal_the_whole(spark, games, borders):
    m = memory()
    outs, last = by_steps(games, borders, m)
    played = F.col("played") == 1
    whole = series.expanding_avg(games, {"m": F.when(played, F.col("v")), "share": F.col("played")}, ["k"], ["day", "g"])
    whole = series.rolling_avg(whole, {"r": "v"}, 4, ["k"], ["day", "g"], "n")
    key = lambda r: (r.k is None, r.k or 0, r.day, r.g)
    got = sorted([r for o in outs for r in o.collect()], key=key)
    want = sorted(whole.collect(), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert key(a) == key(b) and a.n == b.n
        for c in ("m", "share", "r"):
            assert a[c] == pytest.approx(b[c]) if b[c] is not None else a[c] is None
    flagged = carry.with_last_flag(games, last, m, "flag")
    want = series.last_active_flag(games, "flag", played, ["k"], ["day", "g"])
    assert sorted(map(str, flagged.collect())) == sorted(map(str, want.collect()))


def test_states_pass_on_and_are_bounded(spark, games):
    m = memory()
    states = carry.states(games, m).collect()
    keys = {r.k for r in games.collect()}
    assert {r.day for r in states} == set(DAYS)
    assert {r.k for r in states if r.day == DAYS[-1]} == keys
    assert all(len(r.last_rows) <= 3 for r in states) and len(states) == len({(r.k, r.day) for r in states})
    assert carry.states(games.limit(0), m).count() == 0
    with pytest.raises(ValueError):
        carry.carried_rolling(games, memory(1), {"r": "v"}, 4, carry.states(games, memory(1)))


def test_states_deal_a_series_out_once(games):
    """Numbering the rows of a day, summing them and the window over the days share one exchange."""
    plan = carry.states(games, memory())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan


LOG = "game_id string, team_id string, season_id string, game_date string"


def test_upsert_rewrites_one_day(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    log = spark.createDataFrame([(f"g{d}", "t", "22024", f"2024-01-{d:02d}") for d in range(1, 6)], LOG)
    first = spark.createDataFrame([(f"g{d}", p, "1") for d in range(1, 6) for p in "ab"], "gameid string, personid string, pts string")
    by_day.upsert_days(by_day.placed_by_log(first, log), path, ["gameid", "personid"])
    stamp = lambda: {p.parent.name: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = stamp()
    batch = spark.createDataFrame([("g3", "a", "9", "n"), ("g3", "c", "5", "n")], "GameId string, personid string, pts string, extra string")
    for _ in range(2):
        done = by_day.upsert_days(by_day.placed_by_log(batch.toDF("gameid", "personid", "pts", "extra"), log), path, ["gameid", "personid"])
        assert done == [("22024", date(2024, 1, 3))]
    after = stamp()
    assert {d for d in after if after[d] != before[d]} == {"day=2024-01-03"} and before.keys() == after.keys()
    got = by_day.read_days(spark, path)
    assert got.count() == 11 and rows(got.filter("gameid = 'g3'"), "personid", "pts", "extra") == [("a", "9", "n"), ("b", "1", None), ("c", "5", "n")]
    one = by_day.read_days(spark, path, date(2024, 1, 4), date(2024, 1, 4))
    assert [f.split("day=")[1][:10] for f in one.inputFiles()] == ["2024-01-04"] or "PartitionFilters: [isnotnull(day" in one._sc._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert rows(one, "gameid") == [("g4",), ("g4",)]


def test_upsert_follows_a_moved_game_and_checks_its_layout(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    log = lambda day: spark.createDataFrame([("g1", "t", "22024", day), ("g2", "t", "22024", "2024-01-02")], LOG)
    batch = spark.createDataFrame([("g1", "1"), ("g2", "2"), ("g9", "9"), (None, "0")], "gameid string, pts string")
    by_day.upsert_days(by_day.placed_by_log(batch, log("2024-01-01")), path, ["gameid"])
    moved = spark.createDataFrame([("g1", "7")], "gameid string, pts string")
    done = by_day.upsert_days(by_day.placed_by_log(moved, log("2024-01-05")), path, ["gameid"])
    assert {str(d) for _, d in done} == {"2024-01-01", "2024-01-05"}
    got = by_day.read_days(spark, path, placed=True)
    assert rows(got.select("gameid", "pts", F.col("day").cast("string"))) == [("g1", "7", "2024-01-05"), ("g2", "2", "2024-01-02"), ("g9", "9", None), (None, "0", None)]
    known = spark.createDataFrame([("g9", "t", "22024", "2024-01-09")], LOG)
    by_day.upsert_days(by_day.placed_by_log(spark.createDataFrame([("g9", "8")], "gameid string, pts string"), known), path, ["gameid"])
    assert rows(by_day.read_days(spark, path, placed=True).filter("gameid = 'g9'").select("pts", F.col("day").cast("string"))) == [("8", "2024-01-09")]
    with pytest.raises(ValueError, match="written with keys"):
        by_day.upsert_days(by_day.placed_by_log(moved, log("2024-01-05")), path, ["gameid", "pts"])
    with pytest.raises(FileNotFoundError):
        by_day.read_days(spark, str(tmp_path / "none"))


def test_ingest_keeps_the_latest_version_in_any_order(spark, rows, tmp_path):
    schema = text_schema(["id", "version", "v"])
    lines = {"a": [("1", "3", "x3"), ("2", "1", "y1")], "b": [("1", "1", "x1"), ("2", "2", "y2")], "c": [("1", "2", "x2"), ("", "9", "null key")]}
    for order in ("abc", "cab", "bca"):
        src, target = tmp_path / order, str(tmp_path / f"t{order}")
        src.mkdir()
        run = lambda: ingest.ingest_stream(spark, str(src), target, ["id"], schema, str(tmp_path / f"c{src.name}"), 2, version="version").awaitTermination()  # noqa: E731, B023
        for i, f in enumerate([*order, order[0], order[1]]):  # two files come again under another name
            (src / f"{i}.csv").write_text("id,version,v\n" + "".join(",".join(r) + "\n" for r in lines[f]))
            if i != 1:
                run()
        assert rows(writers.read_raw(spark, target).select("id", "version", "v")) == [("1", "3", "x3"), ("2", "2", "y2")]


def test_csv_headers_take_one_job(spark, tmp_path):
    kinds = ["a,b", "b,c,a", "c"]
    for i in range(60):
        names = kinds[i % 3].split(",")
        (tmp_path / f"f {i:02d}.csv").write_text(kinds[i % 3] + "\n" + "".join(",".join(f"{n}{i}" for n in names) + "\n" for _ in range(2)))
    (tmp_path / "z.csv").write_text("")
    files = readers._files(spark, f"{tmp_path}/*.csv")
    assert {k: len(v) for k, v in readers._headers(spark, files).items()} == dict.fromkeys(kinds, 20)
    group = "csv-headers"
    spark.sparkContext.setJobGroup(group, "reading")
    got = readers.read_csv_union_by_name(spark, f"{tmp_path}/*.csv", text_schema(["a", "b", "c"]))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= len(kinds) + 1
    spark.sparkContext.setJobGroup("rest", "rest")
    assert got.count() == 120 and {(r.a, r.b, r.c) for r in got.filter("a = 'a0' OR c = 'c2' OR b = 'b1'").collect()} == {("a0", "b0", None), ("a1", "b1", "c1"), (None, None, "c2")}


def test_ranks_of_a_narrow_range_are_dealt(spark):
    rng = random.Random(1)
    values = [1.0 + rng.randrange(1000) * 5e-7 for _ in range(3000)] + [float("nan"), float("inf"), None, 0.0, -0.0]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double").withColumn("w", F.col("id") % 7)
    seen, keep = [], stats.materialise
    try:
        stats.materialise = lambda d, n: (seen.append(keep(d, n)), seen[-1])[1]
        got = stats.rank_each(df, {"v": ("r", "d"), "w": (None, "wd")}, buckets=8).collect()
    finally:
        stats.materialise = keep
    assert seen[0].filter("__c = 0").groupBy("__b").count().count() > 3
    order = lambda v: (v != v, v if v == v else 0)
    known = [order(v) for v in values if v is not None]
    distinct = set(known)
    for r in got[:: len(got) // 200]:
        v = values[r.id]
        if v is None:
            assert r.r is None and r.d is None
        else:
            assert (r.r, r.d) == (1 + sum(x > order(v) for x in known), 1 + sum(x > order(v) for x in distinct))
        assert r.wd == 7 - r.id % 7


def test_group_rows_without_exchange_of_facts(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    want = {(r.k, r.v): r.z for r in stats.zscores(df, {"z": "v"}, ["k"]).collect()}
    salted = stats.zscores(df, {"z": "v"}, ["k"], few=10)
    assert {(r.k, r.v): r.z for r in salted.collect()} == pytest.approx(want)
    plan = lambda d: d._sc._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
    few = plan(stats.zscores(df, {"z": "v"}, ["k"]))
    assert "BroadcastHashJoin" in few and "Exchange hashpartitioning" not in few


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = stats.numbered(df, [F.col("v").desc()], "p").collect()
    assert all(r.p == 1000 - r.v for r in got) and len(got) == 1000
    assert stats.numbered(df.limit(0), [F.col("v")], "p").count() == 0
