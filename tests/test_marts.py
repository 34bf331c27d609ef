"""The mart chain: stored daily build, blocked against plain windows, and the oracles."""

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from catalogue import domain, generic, inputs, storage
from catalogue.domain import Domain
from check import compare, connect
from statmart.operators.series import time_block
from statmart.plans import averages as av
from statmart.plans import fantasy as fa
from statmart.plans import pipeline
from statmart.plans import processed as pr
from statmart.plans.reconcile import games_to_refresh

SMALL = "/root/testdata/sf0.001"
# One or two of every operator family; tools/check.py runs them all.
CHECKED = (
    "season_z_ranking expanding_avg_played rolling10_full rolling3_delta totals_z weekly_stats season_final team_schedule "
    "team_record vs_opponent opponent_outcomes star_join_typed chain_join_typed half_totals global_rank zscore_hot_groups "
    "category_leaders series_expanding_blocked series_rolling_blocked series_neighbours_blocked upsert_delete_insert "
    "upsert_merge_coalesce snapshot_upsert missing_keys roster_flatten fuzzy_levenshtein trade_2for2 text_formatters "
    "mart_player_averages mart_season_ranks mart_week_leaders mart_season_final mart_ranked_positions roster_documents "
    "fuzzy_best_score player_map_named raw_upsert_days log_upsert refresh_averages refresh_last_10 refresh_performance "
    "refresh_range_days ingest_shuffled csv_union_by_name game_csv trade_csv"
).split()


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_oracle(spark, oracle, name):
    assert compare(spark, oracle, name, SMALL).startswith(("ok", "rows only"))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own, sql = ({**getattr(generic, x), **getattr(domain, x), **getattr(storage, x)} for x in ("QUERIES", "ORACLES"))
    assert set(own) - set(sql) == {"fuzzy_ratio", "search_topk"}


@pytest.fixture(scope="module")
def marts(spark):
    return Domain(spark, SMALL)


def same(a, b):
    kinds = {f.name: f.dataType.typeName() for f in a.schema.fields}
    rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in kinds.items()])
    return rounded(a).exceptAll(rounded(b)).count() == 0 and a.count() == b.count()


def test_blocked_marts_equal_plain_marts(spark, marts):
    block = time_block("gameDate", "day")
    teams = marts._keep("teams_combined", marts.teams_combined)
    assert same(pr.teams_processed(teams), pr.teams_processed(teams, block))
    base = marts.base()
    assert same(av.averages(base), av.averages(base, block))
    assert same(av.averages_last_n(base, 4), av.averages_last_n(base, 4, block))
    avg = marts._keep("averages", marts.averages)
    assert same(fa.performance_delta(base, avg), fa.performance_delta(base, avg, block=block))


def test_expanding_mean_at_last_row_is_the_group_mean(marts):
    base = marts.base()
    last = av.averages_current(av.averages(base)).select("personId", "seasonId", "average_points")
    mean = base.filter("playedFlag = 1").groupBy("personId", "seasonId").agg(F.avg("points").alias("m"))
    both = last.join(mean, ["personId", "seasonId"], "full")
    assert both.filter("abs(average_points - m) > 1e-9 OR average_points IS NULL AND m IS NOT NULL").count() == 0


def test_daily_build(spark, marts, tmp_path):
    root = str(tmp_path)
    for name in inputs.RAW:
        marts.raw(name).write.parquet(f"{root}/raw/{name}")
    written = pipeline.run(spark, root)
    assert len(written) == 20
    final = spark.read.parquet(written["fantasy.season_final"])
    assert same(final, marts.season_final().select(*final.columns))
    before = spark.read.parquet(written["base.players_combined"]).count()
    again = pipeline.run(spark, root, date(2024, 1, 20), date(2024, 1, 22))
    assert spark.read.parquet(again["base.players_combined"]).count() == before


def test_block_choice(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("k"), F.current_date().alias("gameDate"))
    assert pipeline.block_for(df, ["k"], limit=25) is None
    assert pipeline.block_for(df, ["k"], limit=24) is not None


def test_games_to_refresh(spark, rows):
    df = spark.createDataFrame([("22500059",), ("0022500059",)], "game_id string")
    assert rows(games_to_refresh(df)) == [("0022500059",)]
