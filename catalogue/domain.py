"""Queries over the domain tables: every mart from raw text to rankings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.operators import trades
from statmart.operators.stats import numbered
from statmart.plans import averages as av
from statmart.plans import combined as cb
from statmart.plans import fantasy as fa
from statmart.plans import measures as m
from statmart.plans import processed as pr
from statmart.plans import reconcile as rc
from statmart.plans import rosters as ro
from statmart.plans import serving as sv
from statmart.session import materialise
from statmart.sources.readers import select_season_log
from statmart.sources.schemas import ENDPOINTS, TRADITIONAL

from . import models_sql as q
from .inputs import F4, derive, duck, layers, r, raw_ctes, raw_table, tidy


class Domain:
    """The mart chain over one data folder. Lazy, except that what three or more
    consumers share is written once: the player-games and team-games behind the raw
    tables, ``base``, and the one-row-per-player inputs of the z-scores."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._kept: dict[str, DataFrame] = {}
        self._layers: dict[str, DataFrame] = {}

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = materialise(build(), name)
        return self._kept[name]

    def raw(self, name: str) -> DataFrame:
        if not self._layers:
            self._layers = layers(self.spark, self.sf)
        if name not in self._kept:
            self._kept[name] = raw_table(self._layers, name)
        return self._kept[name]

    def season(self) -> DataFrame:
        return cb.current_season(self.raw("log_table"))

    def totals(self) -> DataFrame:
        return cb.team_totals(self.raw("teams_traditional"))

    def lines(self) -> DataFrame:
        return cb.game_lines(self.raw("lines_table"), self.raw("line_team_mapping"), self.raw("log_table"))

    def teams_combined(self) -> DataFrame:
        sources = {e: self.raw(f"teams_{e}") for e in ENDPOINTS if e != "traditional"}
        return cb.teams_combined(self.raw("log_table"), {**sources, "traditional": self.totals()}, self.lines())

    def players_combined(self, columns: list[str] | None = None) -> DataFrame:
        return cb.players_combined(self.raw("log_table"), {e: self.raw(f"players_{e}") for e in ENDPOINTS}, columns)

    def teams_processed(self) -> DataFrame:
        # Stored first: the opponent self join would otherwise run the star join twice.
        return pr.teams_processed(self._keep("teams_combined", self.teams_combined))

    def players_processed(self) -> DataFrame:
        return pr.players_processed(self.players_combined(), self.teams_processed())

    def base_lazy(self) -> DataFrame:
        # A player's own statistics take nothing from the team's row, of which a game has one.
        return fa.base_stats(pr.player_facts(self.players_combined(fa.BASE_INPUT)))

    def base(self) -> DataFrame:
        return self._keep("base", self.base_lazy)

    def averages(self) -> DataFrame:
        return av.averages(self.base())

    def averages_current(self) -> DataFrame:
        return self._keep("avgcur", lambda: av.averages_current(self.averages()))

    def last10_current(self) -> DataFrame:
        return self._keep("lastcur", lambda: av.averages_last_n_current(av.averages_last_n(self.base())))

    def cumulative(self) -> DataFrame:
        return self._keep("cum", lambda: fa.season_cumulative(self.base(), self.season()))

    def z_averages(self) -> DataFrame:
        return fa.z_scores_averages(self.averages_current())

    def z_last10(self) -> DataFrame:
        return fa.z_scores_last_n(self.last10_current())

    def z_cumulative(self) -> DataFrame:
        return fa.z_scores_cumulative(self.cumulative())

    def weekly(self) -> DataFrame:
        return fa.weekly_stats(self.base(), self.season())

    def season_final(self) -> DataFrame:
        return fa.season_sheet(self.base(), self.season())

    def overall(self) -> DataFrame:
        return fa.z_overall_current(self.z_cumulative(), self.z_averages(), self.z_last10())

    def player_map(self) -> DataFrame:
        """Everyone in the first events snapshot against the known players."""
        roster = derive(self.spark, self.sf, F4).withColumnsRenamed({"player_id": "playerId"})
        return ro.player_map(roster, self.players_combined(ro.NAME_INPUT)).drop("created_at")

    def player_z(self) -> DataFrame:
        return trades.player_z_with_last10(self.z_averages(), self.averages_current(), self.z_last10())


def _q(build: Callable[[Domain], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: tidy(build(Domain(spark, sf)))


def _positions(df: DataFrame) -> DataFrame:
    """Number the rows as they lie, so that their order can be compared."""
    return numbered(df.withColumn("__at", F.monotonically_increasing_id()), [F.col("__at")], "position").drop("__at")


COMBINED_TEAM = "gameId gameDate teamTricode seasonId teamId teamName teamCity matchup winLoss".split()
COMBINED_TEAM_NUM = ["plusMinus", "line", "overUnder", "minutes", *m.TEAM_MEASURES]
COMBINED_PLAYER = (
    "seasonId teamId teamAbbreviation teamName gameId gameDate matchup winLoss personId firstName familyName playerSlug "
    "position comment teamCity minutes"
).split()
TEAM_PLAIN = (
    "gameId nextGameId gameDate seasonId seasonType teamId teamTricode teamName teamCity homeTeam awayTeam homeGame matchup "
    "gameNumber daysSinceLastGame isBackToBack is3In4 is4In6 isLastTeamGame winLoss coverResult overUnderResult winsSoFar "
    "lossesSoFar winsVsOpponent lossesVsOpponent"
).split()
TEAM_NUM = ["line", "overUnder", "points", "opponentPoints", "totalPoints", "scoreDiff", "last10WinPercentage", *m.TEAM_OUTPUT]
BASE_NUM = "minutes points assists steals blocks reboundsTotal threePointersMade effectiveFieldGoalPercentage freeThrowsPercentage".split()
Z_PLAIN = ["seasonId", "personId", *q.NAMES]
Z_NUM = [*fa.Z_NAMES, "totalZ"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_current_season": _q(lambda d: d.season()),
    "mart_team_totals": _q(lambda d: d.totals()),
    "mart_game_lines": _q(lambda d: d.lines()),
    "mart_teams_combined": _q(lambda d: d.teams_combined()),
    "mart_players_combined": _q(lambda d: d.players_combined()),
    "mart_teams_processed": _q(lambda d: d.teams_processed()),
    "mart_players_processed": _q(lambda d: d.players_processed()),
    "mart_team_averages": _q(lambda d: av.team_averages(d.teams_processed())),
    "mart_player_averages": _q(lambda d: av.player_averages(d.players_processed())),
    "mart_base_stats": _q(lambda d: d.base_lazy()),
    "mart_base_stats_current": _q(lambda d: fa.base_stats_current(d.base_lazy(), d.season())),
    "mart_averages": _q(lambda d: av.averages(d.base_lazy())),
    "mart_averages_current": _q(lambda d: av.averages_current(av.averages(d.base_lazy()))),
    "mart_averages_last_10": _q(lambda d: av.averages_last_n(d.base_lazy())),
    "mart_averages_last_10_current": _q(lambda d: av.averages_last_n_current(av.averages_last_n(d.base_lazy()))),
    "mart_season_cumulative": _q(lambda d: fa.season_cumulative(d.base_lazy(), d.season())),
    "mart_z_averages": _q(lambda d: d.z_averages()),
    "mart_z_last_10": _q(lambda d: d.z_last10()),
    "mart_z_cumulative": _q(lambda d: d.z_cumulative()),
    "mart_z_overall_current": _q(lambda d: d.overall()),
    "mart_weekly_stats": _q(lambda d: d.weekly()),
    "mart_season_final": _q(lambda d: d.season_final()),
    "mart_performance_delta": _q(lambda d: fa.performance_delta(d.base(), d.averages())),
    "mart_player_z_with_last10": _q(lambda d: d.player_z()),
    "mart_ranked_season": _q(lambda d: sv.ranked(d.z_averages(), d.season())),
    "mart_ranked_positions": _q(lambda d: _positions(sv.ranked(d.z_averages(), d.season()))),
    "mart_player_z_positions": _q(lambda d: _positions(d.player_z()).select("personId", "seasonId", "totalZ", "position")),
    "mart_week_positions": _q(lambda d: _positions(sv.week_directory(d.weekly())).select("seasonWeekId", "position")),
    "mart_ranked_last10_top": _q(lambda d: sv.ranked(d.z_last10(), d.season(), 500)),
    "mart_season_ranks": _q(lambda d: sv.season_ranks(d.season_final(), 22025)),
    "mart_week_leaders": _q(lambda d: sv.category_leaders(d.weekly())),
    "mart_week_directory": _q(lambda d: sv.week_directory(d.weekly())),
    "mart_latest_week": _q(lambda d: sv.latest_week(d.weekly())),
    "mart_week_rows": _q(lambda d: sv.week_rows(d.weekly(), 22025, 2)),
    "mart_week_top25": _q(lambda d: sv.top_players(sv.week_rows(d.weekly(), 22025, 2))),
    "mart_week_breakouts": _q(lambda d: sv.weekly_breakouts(sv.breakouts_from(d.weekly(), d.season_final()), 22025, 2)),
    "mart_season_log": _q(lambda d: select_season_log(d.raw("log_table"), 2024)),
    "mart_missing_games": _q(
        lambda d: rc.missing_games(
            d.raw("log_table"), d.raw("teams_misc").withColumn("gameid", F.expr("CASE WHEN teamtricode < 'T5' THEN gameid END")), d.raw("players_misc")
        )
    ),
    "mart_stored_games": _q(lambda d: rc.stored_games(d.raw("players_misc"), d.raw("log_table"), "22025")),
    "mart_player_map": _q(lambda d: d.player_map()),
}


def _ranked(source: str, name: str) -> str:
    cols = ", ".join(r(c) for c in ["totalZ", *fa.Z_NAMES])
    return q.model_sql(
        name,
        f"SELECT RANK() OVER (ORDER BY totalZ DESC) AS player_rank, firstName, familyName, {cols} FROM {source} "
        "WHERE totalZ IS NOT NULL AND seasonId = (SELECT seasonId FROM current_season)",
    )


def _fmt(c: str) -> str:
    def half_even(x: str, n: int) -> str:
        return f"round_even({x}, {n})"

    return (
        f"CASE WHEN {c} IS NULL THEN '' WHEN abs({c}) >= 10 THEN printf('%.0f', {half_even(c, 0)}) "
        f"WHEN abs({c}) >= 1 THEN printf('%.2f', {half_even(c, 2)}) ELSE printf('%.3f', {half_even(c, 3)}) END"
    )


def _leaders() -> str:
    parts = []
    for name, (value, z) in sv.WEEK_CATEGORIES.items():
        by = z or value
        shown = f"CAST({value} AS DOUBLE)"
        z_shown = _fmt(f"CAST({z} AS DOUBLE)") if z else "''"
        parts.append(
            f"""SELECT w.seasonId, w.weekNumber, '{name}' AS category, COALESCE(b.player, 'N/A') AS player,
              COALESCE(b.value, '') AS value, COALESCE(b.z_score, '') AS z_score
              FROM (SELECT DISTINCT seasonId, weekNumber FROM weekly_stats) w LEFT JOIN (
              SELECT seasonId, weekNumber, firstName || ' ' || familyName AS player, {_fmt(shown)} AS value, {z_shown} AS z_score,
                ROW_NUMBER() OVER (PARTITION BY seasonId, weekNumber ORDER BY {by} DESC, personId) AS rn
              FROM weekly_stats WHERE {by} IS NOT NULL) b
              ON w.seasonId = b.seasonId AND w.weekNumber = b.weekNumber AND b.rn = 1"""
        )
    return q.model_sql("weekly_stats", " UNION ALL ".join(parts))


Z_AVG = q.final("z_averages", [*Z_PLAIN, "gameDate"], Z_NUM)
ORACLES: dict[str, str] = {
    "mart_current_season": q.model_sql("current_season", "SELECT seasonId FROM current_season"),
    "mart_team_totals": q.final(
        "totals", "gameid teamid teamcity teamname teamtricode teamslug minutes".split(), TRADITIONAL
    ),
    "mart_game_lines": q.final("game_lines", ["gameId", "gameDate", "teamTricode"], ["line", "ou"]),
    "mart_teams_combined": q.final("teams_combined", COMBINED_TEAM, COMBINED_TEAM_NUM),
    "mart_players_combined": q.final("players_combined", COMBINED_PLAYER, list(m.PLAYER_MEASURES)),
    "mart_teams_processed": q.final("teams_processed", TEAM_PLAIN, TEAM_NUM),
    "mart_players_processed": q.final(
        "players_processed", q.PLAYER_AVG_KEEP, ["minutes", *m.PLAYER_OUTPUT, "last10WinPercentage"]
    ),
    "mart_team_averages": q.final(
        "team_averages", q.TEAM_AVG_KEEP, q.TEAM_AVG_NUM + [m.average_name(c, True) for c in m.TEAM_AVERAGED]
    ),
    "mart_player_averages": q.final(
        "player_averages", q.PLAYER_AVG_KEEP,
        ["last10WinPercentage", "average_played_flag", *[m.average_name(c, False) for c in m.PLAYER_AVERAGED]],
    ),
    "mart_base_stats": q.final("base_stats", [*q.GAME, "doubleDouble"], BASE_NUM),
    "mart_base_stats_current": q.final("base_stats", [*q.GAME, "doubleDouble"], BASE_NUM)
    + " WHERE seasonId = (SELECT seasonId FROM current_season)",
    "mart_averages": q.final("averages", q.GAME, ["average_played_flag", *q.AVGS]),
    "mart_averages_current": q.final("averages_current", q.GAME, ["average_played_flag", *q.AVGS]),
    "mart_averages_last_10": q.final("averages_last_10", [*q.GAME, "games_in_window"], list(m.LAST10_NAMES.values())),
    "mart_averages_last_10_current": q.final(
        "averages_last_10_current", [*q.GAME, "games_in_window"], list(m.LAST10_NAMES.values())
    ),
    "mart_season_cumulative": q.model_sql(
        "season_cumulative",
        f"SELECT {', '.join([*Z_PLAIN, 'gamesPlayed', *[r(c) for c in q.CUMS if c != 'doubleDoubleCumulative']])}, "
        "CAST(doubleDoubleCumulative AS BIGINT) AS doubleDoubleCumulative FROM season_cumulative",
    ),
    "mart_z_averages": Z_AVG,
    "mart_z_last_10": q.final("z_last10", [*Z_PLAIN, "gameDate"], Z_NUM),
    "mart_z_cumulative": q.final("z_cumulative", Z_PLAIN, Z_NUM),
    "mart_z_overall_current": q.final(
        "z_overall", "seasonid personid firstname familyname avg_gamedate last10_gamedate".split(),
        ["cum_totalz", "avg_totalz", "last_10_totalz", *[f"{p}_{x}" for p in ("avg", "cum") for x in q.LOW.values()]],
    ),
    "mart_weekly_stats": q.model_sql(
        "weekly_stats",
        f"SELECT {', '.join([*q.WEEK_PLAIN, *[r(c) for c in q.WEEK_NUM if c != 'doubleDoubleSum']])}, "
        "CAST(doubleDoubleSum AS BIGINT) AS doubleDoubleSum FROM weekly_stats",
    ),
    "mart_season_final": q.model_sql(
        "season_final",
        f"SELECT {', '.join([*Z_PLAIN, 'gamesPlayed', *[r(c) for c in q.FINAL_NUM if c != 'cum_double_double']])}, "
        "CAST(cum_double_double AS BIGINT) AS cum_double_double FROM season_final",
    ),
    "mart_performance_delta": q.final("performance_delta", q.DELTA_KEEP, q.DELTA_NUM),
    "mart_player_z_with_last10": q.final("player_z", [*Z_PLAIN, "gameDate"], [*Z_NUM, "last_10_z"]),
    "mart_ranked_season": _ranked("z_averages", "z_averages"),
    "mart_ranked_positions": q.model_sql(
        "z_averages",
        f"SELECT RANK() OVER (ORDER BY totalZ DESC) AS player_rank, firstName, familyName, {', '.join(r(c) for c in ['totalZ', *fa.Z_NAMES])}, "
        "ROW_NUMBER() OVER (ORDER BY z_averages.totalZ DESC, personId) AS position FROM z_averages "
        "WHERE totalZ IS NOT NULL AND seasonId = (SELECT seasonId FROM current_season)",
    ),
    "mart_player_z_positions": q.model_sql(
        "player_z",
        f"SELECT personId, seasonId, {r('totalZ')}, ROW_NUMBER() OVER (ORDER BY player_z.totalZ DESC NULLS LAST, personId) AS position FROM player_z",
    ),
    "mart_week_positions": q.model_sql(
        "weekly_stats",
        "SELECT seasonWeekId, ROW_NUMBER() OVER (ORDER BY seasonId, weekNumber) AS position FROM (SELECT DISTINCT seasonId, weekNumber, seasonWeekId FROM weekly_stats)",
    ),
    "mart_ranked_last10_top": _ranked("z_last10", "z_last10") + " ORDER BY z_last10.totalZ DESC LIMIT 500",
    "mart_season_ranks": q.model_sql(
        "season_final",
        f"SELECT {', '.join([*Z_PLAIN, 'gamesPlayed', *[r(c) for c in q.FINAL_NUM if c != 'cum_double_double']])}, "
        "CAST(cum_double_double AS BIGINT) AS cum_double_double, "
        + ", ".join(
            f"CASE WHEN {c} IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY {c} DESC NULLS LAST) END AS {o}"
            for c, o in (("zcum_total", "cumulative_rank"), ("zavg_total", "average_rank"))
        )
        + " FROM season_final WHERE seasonId = 22025",
    ),
    "mart_week_leaders": _leaders(),
    "mart_week_directory": q.model_sql(
        "weekly_stats",
        "SELECT DISTINCT seasonId, weekNumber, weekStartDate, weekEndDate, seasonWeekId, 'SZN ' || seasonId || ' | Week ' || weekNumber "
        "|| ' | ' || weekStartDate || ' → ' || weekEndDate AS label FROM weekly_stats",
    ),
    "mart_latest_week": q.model_sql(
        "weekly_stats",
        "SELECT DISTINCT seasonId, weekNumber, weekStartDate, weekEndDate FROM weekly_stats "
        "ORDER BY seasonId DESC, weekNumber DESC LIMIT 1",
    ),
    "mart_week_top25": q.model_sql(
        "weekly_stats",
        "SELECT firstName, familyName, personId, gamesPlayedWeek, "
        + ", ".join(r(c) for c in "pointsSum assistsSum reboundsSum stealsSum blocksSum threesSum totalZWeek".split())
        + ", CAST(doubleDoubleSum AS BIGINT) AS doubleDoubleSum FROM weekly_stats w WHERE seasonId = 22025 AND weekNumber = 2 "
        "ORDER BY w.totalZWeek DESC NULLS LAST, personId LIMIT 25",
    ),
    "mart_week_breakouts": q.model_sql(
        "season_final",
        f"SELECT w.seasonId, w.weekNumber, w.weekStartDate, w.personId, w.firstName, w.familyName, "
        f"{r('w.minutesAvg - f.avg_minutes', 'minutes_delta_week')}, {r('w.pointsAvg - f.avg_points', 'points_delta_week')} "
        "FROM weekly_stats w JOIN season_final f ON w.seasonId = f.seasonId AND w.personId = f.personId "
        "WHERE w.seasonId = 22025 AND w.weekNumber = 2",
    ),
    "mart_season_log": f"WITH {raw_ctes()} SELECT * FROM log_table WHERE (season_id = '22024' AND left(game_id, 3) = '002') "
    "OR (season_id = '42024' AND left(game_id, 3) = '004') OR (season_id = '62024' AND left(game_id, 3) = '006')",
    "mart_missing_games": f"WITH {raw_ctes()} SELECT game_id AS gameid FROM log_table EXCEPT "
    "(SELECT CASE WHEN teamtricode < 'T5' THEN gameid END FROM teams_misc INTERSECT SELECT gameid FROM players_misc)",
    "mart_stored_games": f"WITH {raw_ctes()} SELECT DISTINCT gameid FROM players_misc "
    "WHERE gameid IN (SELECT game_id FROM log_table WHERE season_id = '22025')",
    "mart_player_map": q.model_sql(
        "players_combined",
        f"""SELECT DISTINCT CAST(f.player_id AS VARCHAR) AS espn_player_id, p.personid AS personid, 'exact_norm' AS match_type,
        1.0::DOUBLE AS match_score, f.name AS espn_name, p.nba_name AS nba_name, false AS needs_review FROM ({duck(F4)}) f,
        (SELECT CAST(personId AS VARCHAR) AS personid, firstName || ' ' || familyName AS nba_name FROM players_combined
         WHERE personId IS NOT NULL AND firstName IS NOT NULL ORDER BY 1 LIMIT 1) p""",
    ),
}
ORACLES["mart_week_rows"] = ORACLES["mart_weekly_stats"] + " WHERE seasonId = 22025 AND weekNumber = 2"
