"""The daily build: stored raw tables to stored marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.operators.series import time_block
from statmart.sources.readers import table
from statmart.sources.schemas import ENDPOINTS
from statmart.sources.writers import overwrite_table, refresh_range

from . import averages as av
from . import combined as cb
from . import fantasy as fa
from . import processed as pr

LONG_SERIES = 100_000


def block_for(df: DataFrame, keys: list[str], time_col: str = "gameDate", limit: int = LONG_SERIES) -> Column | None:
    """Plain windows while the longest series is checked to be short, else weekly blocks.

    One narrow aggregation over the stored table (two columns, combined on the map
    side) decides; its single number is all that reaches the driver.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    longest = sizes.agg(F.max("n")).first()[0] or 0
    return time_block(time_col, "week") if longest > limit else None


def run(
    spark: SparkSession, root: str, start: date | None = None, end: date | None = None
) -> dict[str, str]:
    """Build every mart under ``root`` from the raw tables under ``root/raw``.

    With ``start`` and ``end`` the tables that hold a game date are refreshed for those
    days only; the flag of the last played game is always derived from the full history.
    Returns the paths written.
    """
    root = root.rstrip("/")

    def raw(name: str) -> DataFrame:
        return table(spark, f"raw.{name}", root)

    def stored(name: str) -> DataFrame:
        return table(spark, name, root)

    written: dict[str, str] = {}

    def save(name: str, df: DataFrame, by_day: bool = False) -> DataFrame:
        path = f"{root}/{name.replace('.', '/')}"
        if by_day:
            low, high = start or date(1900, 1, 1), end or date(2999, 12, 31)
            refresh_range(lambda: df, low, high, path)
        else:
            overwrite_table(df, path)
        written[name] = path
        return stored(name)

    log = raw("log_table")
    season = cb.current_season(log)
    lines = save("base.lines_table", cb.game_lines(raw("lines_table"), raw("line_team_mapping"), log), True)
    sources = {e: raw(f"teams_{e}") for e in ENDPOINTS if e != "traditional"}
    sources["traditional"] = cb.team_totals(raw("teams_traditional"))
    teams = save("base.teams_combined", cb.teams_combined(log, sources, lines), True)
    players = save("base.players_combined", cb.players_combined(log, {e: raw(f"players_{e}") for e in ENDPOINTS}), True)

    team_block = block_for(teams, ["teamId", "seasonId"])
    teams_proc = save("base.teams_processed", pr.teams_processed(teams, team_block))
    known = players.filter(F.col("personId").isNotNull())
    block = block_for(known, ["personId", "seasonId"])
    players_proc = save("base.players_processed", pr.players_processed(players, teams_proc, block))

    save("aggs.team_averages", av.team_averages(teams_proc, block=team_block))
    save("aggs.player_averages", av.player_averages(players_proc, block=block))
    # Not partitioned by day: it carries the last-game flag, which changes with every new game.
    base = save("fantasy.base_stats", fa.base_stats(players_proc))
    avg = save("fantasy.averages", av.averages(base, block))
    last = save("fantasy.averages_last_10", av.averages_last_n(base, 10, block))
    cum = save("fantasy.season_cumulative", fa.season_cumulative(base, season))
    current = save("fantasy.averages_current", av.averages_current(avg))
    last_current = save("fantasy.averages_last_10_current", av.averages_last_n_current(last))
    z_avg = save("fantasy.z_scores_averages", fa.z_scores_averages(current))
    z_last = save("fantasy.z_scores_last10", fa.z_scores_last_n(last_current))
    z_cum = save("fantasy.z_scores_cumulative", fa.z_scores_cumulative(cum))
    save("fantasy.zscores_overall_current", fa.z_overall_current(z_cum, z_avg, z_last))
    save("fantasy.weekly_stats", fa.weekly_stats(base, season))
    save("fantasy.season_final", fa.season_sheet(base, season))
    save("fantasy.performance_delta", fa.performance_delta(base, avg, block=block_for(base, ["personId"])), True)
    return written
