"""Upserts, key sets, nested rosters, readers, writers and the ingest stream."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from statmart.operators import nested, sets, upsert
from statmart.plans import rosters
from statmart.sources import readers, writers
from statmart.sources.schemas import LINES_SCHEMA, MAPPING_SCHEMA, RAW_SCHEMAS, text_schema
from statmart.streaming.ingest import ingest_stream


def test_upsert_delete_insert(spark, rows):
    target = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), (None, "n", "z")], "id string, v string, gone string")
    batch = spark.createDataFrame([(1, "A", "new"), (9, "i", "new"), (9, "j", "new"), (None, "N", "new")], "ID int, v string, extra string")
    out = upsert.upsert_delete_insert(target, batch, ["ID"])
    assert out.columns == ["id", "v", "gone", "extra"]
    assert rows(out) == [
        ("1", "A", None, "new"), ("2", "b", "y", None), ("9", "i", None, "new"), ("9", "j", None, "new"),
        (None, "N", None, "new"), (None, "n", "z", None),
    ]
    again = upsert.upsert_delete_insert(out.filter("id IS NOT NULL"), batch.filter("ID IS NOT NULL"), ["id"])
    assert rows(again) == rows(out.filter("id IS NOT NULL"))
    with pytest.raises(ValueError):
        upsert.upsert_delete_insert(target, batch, ["absent"])


def test_merge_keeps_known_values(spark, rows):
    target = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, v string, w string")
    batch = spark.createDataFrame([("1", None, "n"), ("3", "c", "n")], "id string, v string, extra string")
    assert rows(upsert.upsert_merge_coalesce(target, batch, ["id"])) == [("1", "a", "x", "n"), ("2", "b", "y", None), ("3", "c", None, "n")]


def test_append_replace_snapshot(spark, rows):
    t = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    b = spark.createDataFrame([("2", "B"), ("3", "C")], "id string, v string")
    assert rows(upsert.append_new(t, b, "id")) == [("1", "a"), ("2", "b"), ("3", "C")]
    assert rows(upsert.replace_key(t, b, "id", "2")) == [("1", "a"), ("2", "B"), ("3", "C")]
    snap = spark.createDataFrame([("d1", "t", 1, "x"), ("d1", "t", 1, "y"), ("d1", "t", None, "n"), ("d1", "t", None, "m")], "d string, t string, p int, n string")
    assert rows(upsert.upsert_snapshot(None, snap, ["d", "t", "p"])) == [("d1", "t", 1, "y"), ("d1", "t", None, "m"), ("d1", "t", None, "n")]


def test_routing():
    assert upsert.key_columns("Traditional", True) == ("teams_traditional", ["gameid", "teamid", "startersbench"])
    assert upsert.key_columns("misc", True) == ("teams_misc", ["gameid", "teamid"])
    assert upsert.key_columns("misc", False) == ("players_misc", ["gameid", "teamid", "personid"])


def test_sets(spark, rows):
    a, b, c = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ([1, 1, 2, 3], [2, 3], [3, 4]))
    assert rows(sets.missing_keys(a, b, c)) == [(1,), (2,)]
    assert rows(sets.missing_local(a, c, b, c)) == [(1,), (2,), (4,)]


ROSTER = {
    "Team One": [
        {"playerId": 7, "name": "A", "injured": True, "avg_points": 10.5, "posRank": 3, "nine_cat_averages": {"PTS": 20.5, "FG%": 0.5, "3PM": 2}},
        {"playerId": "8", "name": "B", "injured": False, "avg_points": "bad", "nine_cat_averages": None},
    ],
    "Empty": [],
    "T2": [{"playerId": None, "name": "C"}],
}


def test_rosters(spark, rows, tmp_path):
    path = tmp_path / "rosters.json"
    path.write_text(json.dumps(ROSTER, indent=2))
    flat = nested.flatten_rosters(readers.read_rosters_json(spark, str(path)), date(2024, 1, 30))
    assert len(flat.columns) == 23
    assert rows(flat, "fantasy_team", "playerId", "injured", "avg_points", "posRank", "nine_pts", "nine_fgpct", "nine_3pm") == [
        ("T2", None, None, None, None, None, None, None),
        ("Team One", 7, True, 10.5, 3, 20.5, 0.5, 2.0),
        ("Team One", 8, False, None, None, None, None, None),
    ]
    docs = nested.nest_rosters(flat, "fantasy_team", F.struct("playerId", "name"))
    assert [r.value for r in docs.collect()] == ['{"T2":[{"name":"C"}],"Team One":[{"playerId":7,"name":"A"},{"playerId":8,"name":"B"}]}']
    back = nested.flatten_rosters(nested.parse_rosters(docs), date(2024, 1, 30))
    assert rows(back, "fantasy_team", "playerId", "name") == rows(flat, "fantasy_team", "playerId", "name")
    older = flat.withColumn("snapshot_date", F.lit(date(2024, 1, 29)))
    snap = rosters.roster_snapshot(older, readers.read_rosters_json(spark, str(path)), date(2024, 1, 30))
    assert snap.count() == 6 and rosters.roster_current(snap).count() == 3


def test_roster_ids(spark, rows, tmp_path):
    (tmp_path / "ids.json").write_text('{"a": [1, "2"], "b": []}')
    got = readers.read_roster_ids(spark, str(tmp_path / "ids.json"))
    assert rows(got.select("team", F.array_join("ids", "|"))) == [("a", "1|2"), ("b", "")]


def test_csv_union_by_name(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("date,team,line\n20240101,X,1\n20240102,Y,2\n")
    (tmp_path / "b.csv").write_text("team,total,line,date\nZ,200,1.5,20240103\n")
    got = readers.read_csv_union_by_name(spark, str(tmp_path / "*.csv"))
    assert rows(got, "date", "team", "line", "total") == [(20240101, "X", 1.0, None), (20240102, "Y", 2.0, None), (20240103, "Z", 1.5, 200)]
    typed = readers.read_csv_union_by_name(spark, str(tmp_path / "*.csv"), LINES_SCHEMA)
    assert set(typed.columns) == set(LINES_SCHEMA.fieldNames()) and typed.schema["total"].dataType.simpleString() == "double"


def test_text_csv_and_seed(spark, rows, tmp_path):
    (tmp_path / "log.csv").write_text("gameId,pts\n0022500059,100\n")
    assert rows(readers.read_text_csv(spark, str(tmp_path / "log.csv"))) == [("0022500059", "100")]
    assert readers.read_text_csv(spark, str(tmp_path / "none.csv"), text_schema(["gameid"])).count() == 0
    (tmp_path / "seed.csv").write_text("raw_data_team_name,log_table_team_name\nX,Team X\n")
    assert rows(readers.read_seed(spark, str(tmp_path / "seed.csv"), MAPPING_SCHEMA)) == [("X", "Team X")]
    assert len(RAW_SCHEMAS) == 12 and len(RAW_SCHEMAS["log_table"]) == 28 and len(RAW_SCHEMAS["players_advanced"]) == 37


def test_bucketed_upsert_and_drift(spark, rows, tmp_path):
    path = str(tmp_path / "raw")
    first = spark.createDataFrame([(f"g{i}", "t", "1") for i in range(20)], "gameid string, teamid string, pts string")
    writers.upsert_table(first, path, ["gameid", "teamid"], buckets=4)
    second = spark.createDataFrame([("g3", "t", "9", "n"), ("h", "t", "5", "n")], "GameId string, teamid string, pts string, extra string")
    for _ in range(2):
        writers.upsert_table(second, path, ["gameid", "teamid"], buckets=4)
    got = writers.read_raw(spark, path)
    assert got.count() == 21
    assert rows(got.filter("gameid IN ('g3', 'g4', 'h')"), "gameid", "pts", "extra") == [("g3", "9", "n"), ("g4", "1", None), ("h", "5", "n")]


def test_refresh_range_touches_only_its_days(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    build = lambda tag, days: spark.createDataFrame([(date(2024, 1, d), tag) for d in days], "gameDate date, v string")
    writers.refresh_range(lambda: build("old", [1, 2, 3, 4]), date(2024, 1, 1), date(2024, 1, 31), path)
    writers.refresh_range(lambda: build("new", [1, 2, 4]), date(2024, 1, 2), date(2024, 1, 3), path)
    got = spark.read.parquet(path)
    assert rows(got.select(F.dayofmonth("gameDate"), "v")) == [(1, "old"), (2, "new"), (4, "old")]


def test_other_writers(spark, rows, tmp_path):
    df = spark.createDataFrame([("g1", "a"), ("g2", "b")], "gameid string, v string")
    writers.write_game(df, str(tmp_path / "g"), "gameid", "g1", overwrite=True)
    writers.write_game(df, str(tmp_path / "g"), "gameid", "g1", overwrite=False)
    assert spark.read.option("header", True).csv(str(tmp_path / "g")).count() == 2
    writers.write_game(df, str(tmp_path / "g"), "gameid", "g1", overwrite=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "g")).count() == 1
    for _ in range(2):
        writers.append_csv(df, str(tmp_path / "a"))
    assert spark.read.option("header", True).csv(str(tmp_path / "a")).count() == 4
    out = writers.write_trade_output(df, " My Team", "Other", str(tmp_path), datetime(2024, 1, 2, 3, 4, 5))
    assert out.endswith("trades_my_team_vs_other_20240102_030405")
    assert spark.read.option("header", True).csv(str(tmp_path / "trades_my_team_vs_other_latest")).count() == 2
    writers.upsert_endpoint("traditional", spark.createDataFrame([("g", "t", "Bench")], "gameid string, teamid string, startersbench string"), None, str(tmp_path / "raw"))
    assert writers.row_count(readers.table(spark, "raw.teams_traditional", str(tmp_path))) == 1


def test_ingest_stream_is_idempotent(spark, rows, tmp_path):
    src, target = tmp_path / "in", str(tmp_path / "t")
    src.mkdir()
    schema = text_schema(["gameid", "teamid", "pts"])
    run = lambda: ingest_stream(spark, str(src), target, ["gameid", "teamid"], schema, str(tmp_path / "cp"), 4).awaitTermination()
    (src / "1.csv").write_text("gameid,teamid,pts\n1,t,10\n2,t,20\n,t,99\n2,t,21\n")
    run()
    (src / "2.csv").write_text("gameid,teamid,pts\n1,t,11\n3,t,30\n")
    run()
    run()
    assert rows(writers.read_raw(spark, target)) == [("1", "t", "11"), ("2", "t", "21"), ("3", "t", "30")]


def test_days_are_written_once(spark, rows, tmp_path, monkeypatch):
    """Refreshed days and a table's first rows go straight to their folders, also where the build reads the table."""
    from statmart.sources import daily as by_day

    def fail(df, name):
        raise AssertionError(f"{name} is written beside the table first")

    for module in (writers, by_day):
        monkeypatch.setattr(module, "materialise", fail)
    path, day = f"{tmp_path}/days", F.to_date(F.concat(F.lit("2024-01-0"), F.col("d")))
    base = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3"), (4, None)], "v int, d string").select("v", day.alias("gameDate"))
    writers.refresh_range(lambda: base, date(2024, 1, 1), date(2024, 1, 31), path)
    again = lambda: spark.read.parquet(path).filter("v <> 3").withColumn("v", F.col("v") * 10).select("v", "gameDate")
    writers.refresh_range(again, date(2024, 1, 2), date(2024, 1, 3), path)
    assert rows(spark.read.parquet(path), "v", F.col("gameDate").cast("string")) == [(1, "2024-01-01"), (20, "2024-01-02")]
    assert sorted(x.name for x in (tmp_path / "days").iterdir() if x.is_dir()) == ["gameDate=2024-01-01", "gameDate=2024-01-02"]
    batch = base.select(F.col("v").cast("string").alias("gameid"), F.lit("22024").alias("season"), F.col("gameDate").alias("day"))
    touched = by_day.upsert_days(batch, f"{tmp_path}/raw", ["gameid"])
    assert len(touched) == 4 and ("22024", None) in touched and ("22024", date(2024, 1, 3)) in touched
    assert rows(by_day.read_days(spark, f"{tmp_path}/raw")) == [("1",), ("2",), ("3",), ("4",)]
