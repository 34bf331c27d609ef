"""Which games still have to be fetched, per endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.text import pad_id
from statmart.operators.sets import missing_keys


def season_games(log: DataFrame) -> DataFrame:
    """Distinct game ids of a log, padded to ten digits."""
    return log.select(pad_id("game_id").alias("gameid")).distinct()


def stored_games(stats: DataFrame, log: DataFrame | None = None, season: str | None = None) -> DataFrame:
    """Distinct stored game ids, optionally only those the log dates to one season."""
    games = stats.select("gameid")
    if log is not None and season is not None:
        wanted = log.filter(F.col("season_id") == str(season)).select(F.col("game_id").alias("gameid"))
        games = games.join(wanted, "gameid", "left_semi")
    return games.distinct()


def missing_games(log: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """Games of the log not stored in both the team and the player table."""
    return missing_keys(season_games(log), stored_games(teams), stored_games(players))


def games_to_refresh(alerts: DataFrame, c: str = "game_id") -> DataFrame:
    """Distinct ids from an alert table."""
    return alerts.select(pad_id(c).alias("gameid")).distinct()
