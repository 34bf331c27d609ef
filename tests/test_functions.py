"""Column functions: casts, text, dates, scores."""

import re
import unicodedata
from datetime import date

import pytest
from pyspark.sql import functions as F

from statmart.functions import casts, dates, scoring, text


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]).select(column.alias("o")).first()[0]


def many(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("c").alias("o")).collect()]


def test_casts(spark):
    assert many(spark, casts.try_long, ["12", "22024.0", "x", None, "1610612737.0", ""]) == [12, 22024, None, None, 1610612737, None]
    assert many(spark, casts.try_double, ["1.5", "n/a", None]) == [1.5, None, None]
    assert many(spark, casts.try_date, ["2024-01-05", "2024", "2024-13-01", None]) == [date(2024, 1, 5), None, None, None]
    assert many(spark, lambda c: casts.at_least(c, -0.5), ["0.1", "-1", None, "x"]) == [True, False, False, False]
    assert many(spark, lambda c: casts.eq_intish(c, 7), ["7", "8", None]) == [True, False, None]


def test_ratio_guard_keeps_value_for_unknown_denominator(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.5, 2.0), (0.5, None)], "x double, d double")
    assert [r[0] for r in df.select(casts.null_if_zero_den("x", "d")).collect()] == [None, 0.5, 0.5]


def test_columns(spark):
    df = spark.createDataFrame([("1", "2")], "` GameId ` string, B string")
    low = casts.lower_columns(df)
    assert low.columns == ["gameid", "b"]
    with pytest.raises(ValueError):
        casts.require_columns(low, ["nope"])
    assert casts.first_existing(df, ["nope", "b"]) == "B"
    assert casts.to_numeric(low, ["gameid", "absent"]).first()[0] == 1.0


def test_clock(spark):
    clocks = ["34:12", "", None, "34", "00:00", "0:05"]
    got = many(spark, text.clock_minutes, clocks)
    assert got[:5] == [34.2, 0.0, 0.0, 0.0, 0.0] and got[5] == pytest.approx(5 / 60)
    assert many(spark, text.played_flag, clocks) == [1, 0, 0, 1, 0, 1]


def test_matchup(spark):
    both = ["AAA vs. BBB", "AAA @ BBB"]
    assert many(spark, text.home_team, both) == ["AAA", "BBB"]
    assert many(spark, text.away_team, both) == ["BBB", "AAA"]
    assert many(spark, text.opponent_code, both) == ["BBB", "BBB"]
    assert many(spark, text.is_home, [*both, None]) == [True, False, False]
    assert many(spark, text.season_type, ["22024", "42024", "62024", None]) == ["REGULAR", "PLAYOFFS", "NBA_CUP", "REGULAR"]


def expected_name(s):
    s = "" if s is None else s.strip().lower()
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    s = re.sub(r"\b(jr|sr|ii|iii|iv|v)\b\.?", "", s)
    return re.sub(r"\s+", " ", re.sub(r"[^a-z\s]", "", s)).strip()


def test_names(spark):
    names = ["Luka Dončić", "  Jaren   Jackson Jr.", "P.J. Tucker", "Robert Williams III", "Şengün, Alperen", "Nikola Jokić",
             "O'Neale", None, "Đorđe", "V. Ivan", "Kelly Oubre jr", "ﬁsh é́", "a b"]
    assert many(spark, text.normalize_name, names) == [expected_name(n) for n in names]
    assert many(spark, text.normalize_name_basic, [" Luka  Dončić. ", "A-B c"]) == ["luka doni", "ab c"]
    assert many(spark, text.slug, [" My Team "]) == ["my_team"]


def test_ids(spark):
    assert many(spark, text.pad_id, ["22500059", "0022500059", "123456789012"]) == ["0022500059", "0022500059", "123456789012"]
    df = spark.createDataFrame([("0022500059, 0022500060",), ("7 8",), ("",)], "c string")
    assert sorted(r[0] for r in text.parse_ids(df, "c", "id").collect()) == ["0022500059", "0022500060", "7", "8"]


def test_format(spark):
    values = [12.5, 13.5, 1.125, 0.0625, -11.2, None, 0.0]
    assert many(spark, text.format_magnitude, values, "double") == [
        "" if v is None else f"{v:.0f}" if abs(v) >= 10 else f"{v:.2f}" if abs(v) >= 1 else f"{v:.3f}" for v in values
    ]
    df = spark.createDataFrame([("A", None, 7), ("A", "B", 8)], "f string, l string, i int")
    assert [r[0] for r in df.select(text.display_name("f", "l", "i")).collect()] == ["7", "A B"]


def test_dates(spark):
    days = [date(2027, 1, 1), date(2025, 7, 31), date(2025, 8, 1)]
    assert many(spark, dates.iso_year_week, days, "date")[0] == "2026-53"
    assert many(spark, dates.season_label, days, "date") == ["2026-27", "2024-25", "2025-26"]
    assert many(spark, lambda c: dates.season_label(c, 6), days, "date")[1] == "2025-26"
    assert many(spark, dates.week_start, days, "date")[0] == date(2026, 12, 28)
    assert many(spark, dates.week_end, days, "date")[0] == date(2027, 1, 3)
    assert many(spark, dates.date_from_int, [20260110, 20261301, None], "bigint") == [date(2026, 1, 10), None, None]


def test_double_double_needs_a_main_category(spark):
    cols = "p double, a double, r double, s double, b double"
    df = spark.createDataFrame([(10., 10., 0., 0., 0.), (0., 0., 0., 10., 10.), (0., 0., 10., 0., 10.), (None, 10., 10., None, None)], cols)
    assert [r[0] for r in df.select(scoring.double_double("p", "a", "r", "s", "b")).collect()] == [1, 0, 1, 1]


def test_outcomes(spark):
    df = spark.createDataFrame([(-3.5, True, 4.0), (-4.0, True, 4.0), (2.5, False, 3.0), (None, True, 9.0)], "l double, h boolean, d double")
    assert [r[0] for r in df.select(scoring.cover_result("l", F.col("h"), "d")).collect()] == ["Cover", "No Cover", "Cover", None]
    df = spark.createDataFrame([(100., 101., 200.), (90., 90., 180.), (1., 1., 9.), (1., 1., None)], "p double, o double, t double")
    assert [r[0] for r in df.select(scoring.over_under_result("p", "o", "t")).collect()] == ["Over", "Push", "Under", None]


def test_accents_of_all_code_points(spark):
    """Every code point that is a variant of ASCII, alone in a text, folds to it."""
    import unicodedata

    points = [chr(c) for c in [*range(0x80, 0xD800), *range(0xE000, 0x30000)]]
    plain = lambda x: "".join(y for y in unicodedata.normalize("NFKD", x) if not unicodedata.combining(y))
    wanted = {c: plain(c) for c in points if plain(c) != c and plain(c) and plain(c).isascii()}
    df = spark.createDataFrame([(c, f"x{c}y") for c in wanted], "c string, t string").select("c", text.fold_accents("t").alias("t"))
    assert {r.c: r.t for r in df.collect()} == {c: f"x{p}y" for c, p in wanted.items()}
    assert len(wanted) > 2000


def test_measures_by_hand():
    """A dozen measures and where they come from, written down apart from the lists that the marts use."""
    from statmart.plans import measures as m

    team = {"points": ["l.pts", "t.points"], "blocks": ["l.blk", "m.blocks", "t.blocks"], "reboundsTotal": ["l.reb", "t.reboundstotal"],
            "pace": ["a.pace"], "pointsPaint": ["m.pointspaint"], "percentagePoints3pt": ["s.percentagepoints3pt"]}
    player = {"points": ["t.points"], "assists": ["t.assists"], "pace": ["a.pace"], "pointsPaint": ["m.pointspaint"],
              "percentagePoints3pt": ["s.percentagepoints3pt"], "usagePercentage": ["a.usagepercentage"]}
    assert {k: m.TEAM_MEASURES[k] for k in team} == team
    assert {k: m.PLAYER_MEASURES[k] for k in player} == player
    assert m.CATEGORIES["threePointersMade"] == ("threes", "average_three_pointers_made") and len(m.CATEGORIES) == 10
