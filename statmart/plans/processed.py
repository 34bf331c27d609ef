"""Facts with context: schedule, outcomes and records for teams; flags and minutes for players.

A season series of a team or player has one row per game, so windows here run per
series. ``block`` switches every window to the blocked form for data without that
bound (see ``operators.series``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import zero_if_null
from statmart.functions.scoring import cover_result, flag, over_under_result
from statmart.functions.text import (
    away_team, clock_minutes, home_team, is_home, opponent_code, played_flag, season_type,
)
from statmart.operators import series as s
from statmart.operators.joins import attach_context, with_opponent

from .measures import PLAYER_OUTPUT, TEAM_OUTPUT

TEAM_CONTEXT = [
    "homeGame", "isBackToBack", "is3In4", "is4In6", "daysSinceLastGame", "isLastTeamGame",
    "winsSoFar", "lossesSoFar", "last10WinPercentage", "winsVsOpponent", "lossesVsOpponent",
]


def opponent_outcomes(teams: DataFrame) -> DataFrame:
    """Season type, venue, opponent points, cover and over/under results."""
    based = teams.withColumns(
        {
            "seasonType": season_type("seasonId"),
            "scoreDiff": zero_if_null("plusMinus"),
            "homeGame": is_home("matchup"),
            "homeTeam": home_team("matchup"),
            "awayTeam": away_team("matchup"),
        }
    )
    paired = with_opponent(based, "gameId", "teamId", {"points": "opponentPoints"})
    return paired.withColumns(
        {
            "coverResult": cover_result("line", F.col("homeGame"), "scoreDiff"),
            "overUnderResult": over_under_result("points", "opponentPoints", "overUnder"),
            "totalPoints": F.col("points") + F.col("opponentPoints"),
            "opponentTricode": opponent_code("matchup"),
        }
    )


def teams_processed(teams: DataFrame, block: Column | None = None) -> DataFrame:
    """Team-games with opponent, outcomes, schedule density and running records.

    Every window starts with (team, season), and the finer ones (season type,
    opponent) are computed on the rows as laid out by it. Ties in date are broken by
    game id.
    """
    order = ["gameDate", "gameId"]
    season = ["teamId", "seasonId"]
    won, lost = F.col("winLoss") == "W", F.col("winLoss") == "L"
    df = opponent_outcomes(teams)
    df = s.sequence_number(df, "gameNumber", season, order, block)
    near = [s.gap_days("daysSinceLastGame", "gameDate"), s.lead_of("nextGameId", "gameId")]
    df = s.over_rows(df, near, season, order, back=1, ahead=1, block=block)
    df = s.count_in_trailing_days(
        df, {"__d4": 3, "__d6": 5}, season, "gameDate", pre_aggregate=block is not None
    )
    df = s.is_last(df, "isLastTeamGame", "gameDate", season, whole=block is None)
    kind = [*season, "seasonType"]
    df = s.running_count(df, {"winsSoFar": won, "lossesSoFar": lost}, kind, order, block)
    df = s.rolling_rate(df, "last10WinPercentage", won, 10, kind, order, block=block)
    versus = ["teamId", "opponentTricode", "seasonId", "seasonType"]
    df = s.running_count(
        df, {"winsVsOpponent": won, "lossesVsOpponent": lost}, versus, order, block, prior_only=True
    )
    return df.withColumns(
        {
            "isBackToBack": s.is_back_to_back("daysSinceLastGame"),
            "is3In4": flag(F.col("__d4") >= 3),
            "is4In6": flag(F.col("__d6") >= 4),
        }
    ).select(
        "gameId", "nextGameId", "gameDate", "seasonId", "seasonType", "teamId", "teamTricode",
        "teamName", "teamCity", "homeTeam", "awayTeam", "homeGame", "matchup", "gameNumber",
        "daysSinceLastGame", "isBackToBack", "is3In4", "is4In6", "isLastTeamGame", "line",
        "overUnder", "winLoss", "points", "opponentPoints", "totalPoints", "scoreDiff",
        "coverResult", "overUnderResult", "winsSoFar", "lossesSoFar", "last10WinPercentage",
        "winsVsOpponent", "lossesVsOpponent", *TEAM_OUTPUT,
    )


def player_facts(players: DataFrame, block: Column | None = None) -> DataFrame:
    """Player-games with played flag, sequence and minutes: what needs no other row than the player's own."""
    order = ["gameDate", "gameId"]
    keys = ["personId", "seasonId"]
    df = players.filter(F.col("personId").isNotNull()).withColumns(
        {"playedFlag": played_flag("minutes"), "minutes": clock_minutes("minutes")}
    )
    played = F.col("playedFlag") == 1
    df = s.next_id(df, "nextGameId", "gameId", keys, order, block)
    df = s.sequence_number(df, "gameCount", keys, order, block)
    df = s.running_count(df, {"gamesPlayed": played}, keys, order, block)
    return s.last_active_flag(df, "isLastGame", played, keys, order, whole=block is None)


def players_processed(
    players: DataFrame, teams_proc: DataFrame, block: Column | None = None
) -> DataFrame:
    """Player-games with played flag, sequence, minutes and the team's context."""
    df = player_facts(players, block)
    df = attach_context(
        df, teams_proc, {"gameId": "gameId", "teamId": "teamId"}, ["teamId"], TEAM_CONTEXT
    )
    return df.select(
        "seasonId", "teamId", "teamAbbreviation", "teamName", "gameId", "nextGameId", "gameDate",
        "teamCity", "personId", "firstName", "familyName", "playerSlug", "position", "comment",
        "gameCount", "playedFlag", "gamesPlayed", "isLastGame", "matchup", "winLoss", "minutes",
        *PLAYER_OUTPUT, *TEAM_CONTEXT,
    )
