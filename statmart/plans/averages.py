"""Season-to-date and last-n averages per team-game and player-game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.operators import series as s

from .measures import (
    CATEGORIES, LAST10_NAMES, PLAYER_AVERAGED, TEAM_AVERAGED, average_name,
)
from .processed import TEAM_CONTEXT

ORDER = ["gameDate", "gameId"]
PLAYER_SERIES = ["personId", "seasonId"]
GAME_KEYS = [
    "seasonId", "gameId", "gameDate", "firstName", "familyName", "personId", "playedFlag", "isLastGame",
]


def team_averages(teams_proc: DataFrame, cols: list[str] | None = None, block: Column | None = None) -> DataFrame:
    """Expanding means of all team measures by (team, season)."""
    means = {average_name(c, True): c for c in cols or TEAM_AVERAGED}
    df = s.expanding_avg(teams_proc, means, ["teamId", "seasonId"], ORDER, block=block)
    return df.select(
        "gameId", "gameDate", "seasonId", "seasonType", "teamId", "teamTricode", "teamName",
        "teamCity", "homeTeam", "awayTeam", "homeGame", "matchup", "gameNumber",
        "daysSinceLastGame", "isBackToBack", "is3In4", "is4In6", "isLastTeamGame", "line",
        "overUnder", "winLoss", "points", "opponentPoints", "totalPoints", "scoreDiff",
        "coverResult", "overUnderResult", *means,
    )


def player_averages(players_proc: DataFrame, cols: list[str] | None = None, block: Column | None = None) -> DataFrame:
    """Expanding means over played games, plus the share of games played."""
    played = F.col("playedFlag") == 1
    means = {average_name(c, False): F.when(played, F.col(c)) for c in cols or PLAYER_AVERAGED}
    means = {"average_played_flag": F.col("playedFlag"), **means}
    df = s.expanding_avg(players_proc, means, PLAYER_SERIES, ORDER, block=block)
    return df.select(
        "seasonId", "teamId", "teamAbbreviation", "teamName", "teamCity", "gameId", "nextGameId",
        "gameDate", "personId", "firstName", "familyName", "playerSlug", "position", "comment",
        "gameCount", "playedFlag", "gamesPlayed", "isLastGame", "matchup", "winLoss",
        *TEAM_CONTEXT, *means,
    )


def averages(base: DataFrame, block: Column | None = None) -> DataFrame:
    """Season-to-date means of the fantasy categories, played games only."""
    played = F.col("playedFlag") == 1
    means = {avg: F.when(played, F.col(c)) for c, (_, avg) in CATEGORIES.items()}
    means = {"average_played_flag": F.col("playedFlag"), **means}
    return s.expanding_avg(base, means, PLAYER_SERIES, ORDER, block=block).select(*GAME_KEYS, *means)


def averages_current(avg: DataFrame) -> DataFrame:
    return avg.filter(F.col("isLastGame") == 1)


def averages_last_n(base: DataFrame, n: int = 10, block: Column | None = None) -> DataFrame:
    """Means of the last ``n`` rows, absences included; rows with a shorter history drop out."""
    means = {out: c for c, out in LAST10_NAMES.items()}
    rolled = s.rolling_avg(base, means, n, PLAYER_SERIES, ORDER, "games_in_window", block)
    return s.require_full(rolled, "games_in_window", n).select(*GAME_KEYS, *means, "games_in_window")


def averages_last_n_current(df: DataFrame, n: int = 10) -> DataFrame:
    return df.filter((F.col("isLastGame") == 1) & (F.col("games_in_window") >= n))
