"""Fantasy marts: base stats, totals, z-scores, weeks, season sheet, pickup signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import null_if_zero_den
from statmart.functions.dates import iso_year_week, week_end, week_start
from statmart.functions.scoring import avg_when, double_double, sum_when, total_of, weighted_score
from statmart.functions.text import concat_text
from statmart.operators import series as s
from statmart.operators.joins import attach, current_season_only, full_outer_merge
from statmart.operators.stats import dense_index, zscores
from statmart.session import materialise

from .averages import GAME_KEYS, ORDER
from .measures import CATEGORIES, LAST10_NAMES, PICKUP_WEIGHTS

# Short names of the ten categories, in ranking order; minutes never counts in a total.
SHORT = [short for short, _ in CATEGORIES.values()]
Z_NAMES = [f"{x}ZScore" for x in SHORT]
TOTAL_MEMBERS = [z for z in Z_NAMES if z != "minutesZScore"]
# Counting categories: those a week or season adds up rather than averages.
COUNTED = {c: short for c, (short, _) in CATEGORIES.items() if not short.endswith("Pct")}
RATES = {c: short for c, (short, _) in CATEGORIES.items() if short.endswith("Pct")}


# Names in the season sheet, in the same order.
SNAKE = dict(
    zip(SHORT, "minutes points assists steals blocks rebounds threes double_double efg_pct ft_pct".split())
)


#: What :func:`base_stats` and the windows before it read of the player facts.
BASE_INPUT = [
    "seasonId", "gameId", "gameDate", "firstName", "familyName", "personId", "minutes", "points", "assists", "steals", "blocks",
    "reboundsTotal", "threePointersMade", "effectiveFieldGoalPercentage", "freeThrowsPercentage", "freeThrowsAttempted",
]


def base_stats(players_proc: DataFrame) -> DataFrame:
    """The ten categories per player-game; free-throw share unknown without attempts."""
    return players_proc.select(
        *GAME_KEYS,
        "minutes", "points", "assists", "steals", "blocks", "reboundsTotal", "threePointersMade",
        "effectiveFieldGoalPercentage",
        null_if_zero_den("freeThrowsPercentage", "freeThrowsAttempted").alias("freeThrowsPercentage"),
        double_double("points", "assists", "reboundsTotal", "steals", "blocks").alias("doubleDouble"),
    )


def base_stats_current(base: DataFrame, season: DataFrame) -> DataFrame:
    return current_season_only(base, season)


def season_cumulative(base: DataFrame, season: DataFrame) -> DataFrame:
    """Totals and mean shares of the current season, one row per player."""
    played = F.col("playedFlag") == 1
    return (
        current_season_only(base, season)
        .groupBy("seasonId", "personId")
        .agg(
            F.max("firstName").alias("firstName"),
            F.max("familyName").alias("familyName"),
            F.count_if(played).alias("gamesPlayed"),
            *[sum_when(played, c).alias(f"{short}Cumulative") for c, short in COUNTED.items()],
            avg_when(played, "effectiveFieldGoalPercentage").alias("avgEfgPct"),
            avg_when(played, "freeThrowsPercentage").alias("avgFtPct"),
        )
    )


def _season_z(df: DataFrame, sources: list[str], carry: list[str]) -> DataFrame:
    scored = zscores(df, dict(zip(Z_NAMES, sources)), ["seasonId"])
    return scored.select("seasonId", "personId", *carry, *Z_NAMES, total_of(TOTAL_MEMBERS).alias("totalZ"))


def z_scores_averages(avg_current: DataFrame) -> DataFrame:
    """Within-season z-scores of the season-to-date means."""
    return _season_z(avg_current, [a for _, a in CATEGORIES.values()], ["firstName", "familyName", "gameDate"])


def z_scores_last_n(last_current: DataFrame) -> DataFrame:
    return _season_z(last_current, list(LAST10_NAMES.values()), ["firstName", "familyName", "gameDate"])


def z_scores_cumulative(cum: DataFrame) -> DataFrame:
    sources = [f"{short}Cumulative" for short in COUNTED.values()] + ["avgEfgPct", "avgFtPct"]
    return _season_z(cum, sources, ["firstName", "familyName"])


def z_overall_current(zcum: DataFrame, zavg: DataFrame, zlast: DataFrame) -> DataFrame:
    """Totals-based z-scores with the latest average-based and last-ten ones; ids as text."""
    newest = zcum.agg(F.max("seasonId").alias("seasonId"))

    def current(df: DataFrame) -> DataFrame:
        return df.filter(F.col("seasonId") == newest.scalar()).withColumn(
            "personId", F.col("personId").cast("string")
        )

    keys = ["seasonId", "personId"]
    c = current(zcum).select(
        *keys, F.col("firstName").alias("__f"), F.col("familyName").alias("__l"),
        *[F.col(z).alias(f"cum_{z.lower()}") for z in Z_NAMES], F.col("totalZ").alias("cum_totalz"),
    )
    a = s.latest_per(current(zavg), keys, ["gameDate"]).select(
        *keys, F.col("firstName").alias("__af"), F.col("familyName").alias("__al"),
        F.col("gameDate").alias("avg_gamedate"), F.col("totalZ").alias("avg_totalz"),
        *[F.col(z).alias(f"avg_{z.lower()}") for z in Z_NAMES],
    )
    last = s.latest_per(current(zlast), keys, ["gameDate"]).select(
        *keys, F.col("gameDate").alias("last10_gamedate"), F.col("totalZ").alias("last_10_totalz")
    )
    return attach(attach(c, a, keys), last, keys).select(
        F.col("seasonId").alias("seasonid"),
        F.col("personId").alias("personid"),
        F.coalesce("__f", "__af").alias("firstname"),
        F.coalesce("__l", "__al").alias("familyname"),
        "avg_gamedate", "last10_gamedate", "cum_totalz", "avg_totalz", "last_10_totalz",
        *[f"avg_{z.lower()}" for z in Z_NAMES], *[f"cum_{z.lower()}" for z in Z_NAMES],
    )


WEEK_Z = [f"{short}ZScoreWeek" for short in COUNTED.values() if short != "minutes"]


def weekly_stats(base: DataFrame, season: DataFrame) -> DataFrame:
    """Monday-to-Sunday totals and means per player, week numbers, z-scores of the totals."""
    played = F.col("playedFlag") == 1
    summed = [sum_when(played, c).alias(f"{short}Sum") for c, short in COUNTED.items()]
    mean_of = {**{c: x for c, x in COUNTED.items() if x != "doubleDouble"}, **RATES}
    meaned = [avg_when(played, c).alias(f"{short}Avg") for c, short in mean_of.items()]
    weekly = (
        current_season_only(base, season)
        .withColumns({"weekStartDate": week_start("gameDate"), "weekEndDate": week_end("gameDate")})
        .groupBy("personId", "firstName", "familyName", "seasonId", "weekStartDate", "weekEndDate")
        .agg(F.count_if(played).alias("gamesPlayedWeek"), *summed, *meaned)
        .withColumn("seasonWeekId", concat_text("seasonId", F.lit("_"), iso_year_week("weekStartDate")))
    )
    numbered = dense_index(weekly, "weekNumber", "weekStartDate", ["seasonId"])
    sources = [f"{short}Sum" for short in COUNTED.values() if short != "minutes"]
    scored = zscores(numbered, dict(zip(WEEK_Z, sources)), ["seasonId", "weekStartDate"])
    return scored.select(
        "personId", "firstName", "familyName", "seasonId", "weekNumber", "weekStartDate",
        "weekEndDate", "seasonWeekId", "gamesPlayedWeek",
        *[f"{short}Sum" for short in COUNTED.values()],
        *[f"{short}Avg" for short in mean_of.values()],
        *WEEK_Z, total_of(WEEK_Z).alias("totalZWeek"),
    )


def season_final(
    avg: DataFrame, zavg: DataFrame, cum: DataFrame, zcum: DataFrame, season: DataFrame
) -> DataFrame:
    """One row per player of the current season: means, totals and z-scores of both."""
    keys = ["seasonId", "personId"]
    snake = SNAKE

    def part(df: DataFrame, tag: str, cols: dict[str, str]) -> DataFrame:
        return current_season_only(df, season).select(
            *keys, F.col("firstName").alias(f"__f_{tag}"), F.col("familyName").alias(f"__l_{tag}"),
            *[F.col(c).alias(out) for c, out in cols.items()],
        )

    means = {a: f"avg_{snake[x]}" for x, a in CATEGORIES.values() if x != "doubleDouble"}
    sums = {f"{x}Cumulative": f"cum_{snake[x]}" for x in COUNTED.values()}
    z_a = {f"{x}ZScore": f"zavg_{snake[x]}" for x in SHORT if x != "minutes"}
    z_c = {f"{x}ZScore": f"zcum_{snake[x]}" for x in SHORT}
    merged = full_outer_merge(
        [
            part(avg.filter(F.col("isLastGame") == 1), "a", means),
            part(zavg, "za", {**z_a, "totalZ": "zavg_total"}),
            part(cum, "c", {
                "gamesPlayed": "gamesPlayed", **sums,
                "avgEfgPct": "cum_avg_efg_pct", "avgFtPct": "cum_avg_ft_pct",
            }),
            part(zcum, "zc", {**z_c, "totalZ": "zcum_total"}),
        ],
        keys,
    )
    tags = ["a", "za", "c", "zc"]
    return merged.select(
        *keys,
        F.coalesce(*[f"__f_{t}" for t in tags]).alias("firstName"),
        F.coalesce(*[f"__l_{t}" for t in tags]).alias("familyName"),
        *means.values(), "gamesPlayed", *sums.values(), "cum_avg_efg_pct", "cum_avg_ft_pct",
        *z_a.values(), "zavg_total", *z_c.values(), "zcum_total",
    )


def season_sheet(base: DataFrame, season: DataFrame) -> DataFrame:
    """:func:`season_final` from base statistics in one grouped pass.

    A player's means up to the last game played are the means of the games played, so one
    aggregation gives means and totals together. What the z-scores need (mean and deviation
    of every measure over the players) is one row a season, aggregated from the players.
    """
    played = F.col("playedFlag") == 1
    keys = ["seasonId", "personId"]
    last = F.max(F.when(played, F.struct(*ORDER, "firstName", "familyName")))
    players = materialise(
        current_season_only(base, season)
        .groupBy(*keys)
        .agg(
            last.alias("__last"), F.max("firstName").alias("__first"), F.max("familyName").alias("__family"),
            F.count_if(played).alias("gamesPlayed"),
            *[avg_when(played, c).alias(f"avg_{SNAKE[x]}") for c, (x, _) in CATEGORIES.items()],
            *[sum_when(played, c).alias(f"cum_{SNAKE[x]}") for c, x in COUNTED.items()],
        ),
        "season-players",
    )
    players = players.withColumns({f"cum_avg_{SNAKE[x]}": F.col(f"avg_{SNAKE[x]}") for x in RATES.values()})
    averaged = {f"zavg_{SNAKE[x]}": f"avg_{SNAKE[x]}" for x in SHORT}
    summed = {f"zcum_{SNAKE[x]}": f"cum_avg_{SNAKE[x]}" if x in RATES.values() else f"cum_{SNAKE[x]}" for x in SHORT}
    scored = zscores(players, {**averaged, **summed}, ["seasonId"])
    total = {f"{t}_total": total_of([f"{t}_{SNAKE[x]}" for x in SHORT if x != "minutes"]) for t in ("zavg", "zcum")}
    return scored.withColumns(total).select(
        *keys,
        F.coalesce("__last.firstName", "__first").alias("firstName"),
        F.coalesce("__last.familyName", "__family").alias("familyName"),
        *[f"avg_{SNAKE[x]}" for x in SHORT if x != "doubleDouble"], "gamesPlayed",
        *[f"cum_{SNAKE[x]}" for x in COUNTED.values()], *[f"cum_avg_{SNAKE[x]}" for x in RATES.values()],
        *[f"zavg_{SNAKE[x]}" for x in SHORT if x != "minutes"], "zavg_total", *[f"zcum_{SNAKE[x]}" for x in SHORT], "zcum_total",
    )


DELTA_SOURCES = {
    "minutes": "average_minutes", "points": "average_points", "assists": "average_assists",
    "steals": "average_steals", "blocks": "average_blocks",
    "rebounds": "average_total_rebounds", "threes": "average_three_pointers_made",
}
_DELTA_INPUT = {"rebounds": "reboundsTotal", "threes": "threePointersMade"}


def performance_delta(
    base: DataFrame, avg: DataFrame, n: int = 3, weights: dict[str, float] | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Last-``n`` means against season means, with a weighted pickup score.

    The last ``n`` rows run across seasons and include absences; rows of absences are
    dropped only afterwards.
    """
    return pickup_sheet(s.rolling_avg(base, recent_means(n), n, ["personId"], ORDER, block=block), avg, n, weights)


def recent_means(n: int) -> dict[str, str]:
    """Name and source of each mean over the last ``n`` rows."""
    return {f"{x}_last{n}": _DELTA_INPUT.get(x, x) for x in DELTA_SOURCES}


def pickup_sheet(rolled: DataFrame, avg: DataFrame, n: int, weights: dict[str, float] | None = None) -> DataFrame:
    """Rows with their :func:`recent_means` against the season means ``avg``; absences drop out."""
    suffix = f"last{n}"
    means = avg.select("personId", "gameId", *DELTA_SOURCES.values())
    joined = attach(rolled, means, ["personId", "gameId"])
    deltas = {f"{x}_delta": F.col(f"{x}_{suffix}") - F.col(a) for x, a in DELTA_SOURCES.items()}
    scored = joined.withColumns(deltas).withColumn("pickup_score", weighted_score(weights or PICKUP_WEIGHTS))
    return scored.filter(F.col("playedFlag") == 1).select(
        "seasonId", "gameId", "gameDate", "personId", "firstName", "familyName", "playedFlag",
        "minutes", "points", "assists", "steals", "blocks", "reboundsTotal", "threePointersMade",
        *DELTA_SOURCES.values(), *[f"{x}_{suffix}" for x in DELTA_SOURCES], *deltas, "pickup_score",
    )
