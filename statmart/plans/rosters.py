"""Roster snapshots and the map from roster players to known persons."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.text import full_name
from statmart.operators.nested import flatten_rosters
from statmart.operators.resolve import RATIO, Metric, fuzzy_match, with_review_flag
from statmart.operators.series import latest_per
from statmart.operators.upsert import latest_snapshot, upsert_snapshot


def roster_snapshot(target: DataFrame | None, rosters: DataFrame, day: date) -> DataFrame:
    """Flatten today's roster documents and merge them into the dated snapshot."""
    return upsert_snapshot(target, flatten_rosters(rosters, day))


def roster_current(snapshot: DataFrame) -> DataFrame:
    return latest_snapshot(snapshot)


#: What :func:`latest_names` reads of the player facts.
NAME_INPUT = ["personId", "firstName", "familyName", "gameDate", "gameId"]


def latest_names(players: DataFrame) -> DataFrame:
    """Latest known full name per person."""
    known = players.filter(
        F.col("personId").isNotNull() & F.col("firstName").isNotNull() & F.col("familyName").isNotNull()
    )
    newest = latest_per(known, ["personId"], ["gameDate", "gameId"])
    return newest.select(
        F.col("personId").cast("string").alias("personid"),
        full_name("firstName", "familyName").alias("nba_name"),
    )


def player_map(
    roster: DataFrame, players: DataFrame, min_score: float = 0.92,
    score_floor: float | None = None, review_below: float = 0.92, metric: Metric = RATIO,
) -> DataFrame:
    """Roster players matched to persons, with match kind, score and review flag.

    Every player gets the best score there is, matched or not; ``score_floor`` leaves out lower ones.
    """
    wanted = roster.filter(F.col("playerId").isNotNull() & F.col("name").isNotNull()).select(
        F.col("playerId").cast("string").alias("espn_player_id"), F.col("name").alias("espn_name")
    ).distinct()
    matched = fuzzy_match(
        wanted, latest_names(players), "espn_player_id", "espn_name", "personid", "nba_name",
        min_score, metric, score_floor,
    )
    stamped = matched.select(
        F.col("left_id").alias("espn_player_id"),
        F.col("right_id").alias("personid"),
        "match_type", "match_score",
        F.col("left_name").alias("espn_name"),
        F.col("right_name").alias("nba_name"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )
    return with_review_flag(stamped, review_below)
