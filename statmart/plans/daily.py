"""The incremental daily build of the fantasy tables.

A day of base statistics is made from that day's raw rows alone, and its averages, last-n means and
pickup signals from those rows and the carry states at the day before (``operators.carry``). Raw
tables lie by season and day (``sources.daily``), so a refresh reads the folders of its days and the
one state folder before them, whatever the length of the history. The flag of the last played game
changes with every new game and is therefore no column of a dated table: readers take it from the
newest state.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.text import clock_minutes, played_flag
from statmart.operators import carry
from statmart.operators.series import require_full
from statmart.sources.daily import read_days
from statmart.sources.schemas import ENDPOINTS
from statmart.sources.writers import partition_days, refresh_range

from . import combined as cb
from . import fantasy as fa
from .averages import GAME_KEYS, ORDER, PLAYER_SERIES
from .measures import CATEGORIES, LAST10_NAMES

DAY = ORDER[0]
LAST_N, RECENT_N = 10, 3
_FACTS = [c for c in GAME_KEYS if c != "isLastGame"]


def season_memory() -> carry.Memory:
    """What a player's season has to remember: sums for the means, and nine rows for the last ten."""
    played = F.col("playedFlag") == 1
    means = {"average_played_flag": F.col("playedFlag"), **{avg: F.when(played, F.col(c)) for c, (_, avg) in CATEGORIES.items()}}
    return carry.Memory(PLAYER_SERIES, ORDER, means, list(LAST10_NAMES), LAST_N - 1, played)


def career_memory() -> carry.Memory:
    """What a player's career has to remember, which the pickup signal follows across seasons."""
    return carry.Memory(["personId"], ORDER, kept=list(fa.recent_means(RECENT_N).values()), n=RECENT_N - 1)


def base_days(log: DataFrame, players: dict[str, DataFrame]) -> DataFrame:
    """Base statistics of the games in ``log``, from rows of these games only."""
    known = cb.players_combined(log, players, fa.BASE_INPUT).filter(F.col("personId").isNotNull())
    facts = known.withColumns(
        {"playedFlag": played_flag("minutes"), "minutes": clock_minutes("minutes"), "isLastGame": F.lit(None).cast("int")}
    )
    return fa.base_stats(facts).drop("isLastGame")


def _paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    tables = {t: f"{root}/daily/{t}" for t in ("base_stats", "averages", "averages_last_10", "performance_delta")}
    return {**tables, **{f"state_{s}": f"{root}/state/{s}" for s in ("season", "career")}}


def state_before(spark: SparkSession, path: str, day: date) -> DataFrame | None:
    """The states at the last border before ``day``: one partition, found by listing."""
    days = [d for d in partition_days(spark, path, DAY) if d < day]
    if not days:
        return None
    return spark.read.parquet(path).filter(F.col(DAY) == F.lit(max(days))).drop(DAY)


def refresh(spark: SparkSession, root: str, start: date, end: date) -> dict[str, str]:
    """Bring the days ``start`` to ``end`` up to date with the raw tables; returns the tables' paths.

    Raw tables are read for these days. Later days that are stored already are carried on from their
    stored base rows, because their averages and states rest on the refreshed ones.
    """
    paths = _paths(root)
    raw = lambda name: read_days(spark, f"{root.rstrip('/')}/raw/{name}", start, end)
    log, players = raw("log_table"), {e: raw(f"players_{e}") for e in ENDPOINTS}
    refresh_range(lambda: base_days(log, players), start, end, paths["base_stats"])
    last = max([end, *partition_days(spark, paths["base_stats"], DAY, end)])
    rows = spark.read.parquet(paths["base_stats"]).filter(F.col(DAY).between(F.lit(start), F.lit(last)))
    season, career = (state_before(spark, paths[f"state_{s}"], start) for s in ("season", "career"))

    def save(name: str, df: DataFrame) -> DataFrame:
        refresh_range(lambda: df, start, last, paths[name])
        return spark.read.parquet(paths[name]).filter(F.col(DAY).between(F.lit(start), F.lit(last)))

    of_season, of_career = season_memory(), career_memory()
    means = carry.carried_means(rows, of_season, season).select(*_FACTS, *of_season.means)
    means = save("averages", means)
    rolled = carry.carried_rolling(rows, of_season, {o: c for c, o in LAST10_NAMES.items()}, LAST_N, season, "games_in_window")
    rolled = require_full(rolled, "games_in_window", LAST_N)
    save("averages_last_10", rolled.select(*_FACTS, *LAST10_NAMES.values(), "games_in_window"))
    recent = carry.carried_rolling(rows, of_career, fa.recent_means(RECENT_N), RECENT_N, career)
    save("performance_delta", fa.pickup_sheet(recent, means, RECENT_N))
    save("state_season", carry.states(rows, of_season, season))
    save("state_career", carry.states(rows, of_career, career))
    return paths


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A daily table; those per game carry ``isLastGame`` as the newest state knows it."""
    paths = _paths(root)
    rows = spark.read.parquet(paths[name])
    if name == "performance_delta":
        return rows
    newest = state_before(spark, paths["state_season"], date.max)
    return carry.with_last_flag(rows, newest, season_memory(), "isLastGame")
