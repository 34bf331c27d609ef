"""Queries the dashboards run: rankings, week directory, leaders, top lists, season sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import eq_intish, first_existing
from statmart.functions.text import display_name, format_magnitude, week_label
from statmart.operators.joins import current_season_only
from statmart.operators.stats import leaders, rank_desc, rank_each, rank_top, top_n

from .fantasy import Z_NAMES

# Weekly categories as shown -> (sum or mean column, z column or none).
WEEK_CATEGORIES = {
    "Total Z": ("totalZWeek", "totalZWeek"),
    "Points": ("pointsSum", "pointsZScoreWeek"),
    "Rebounds": ("reboundsSum", "reboundsZScoreWeek"),
    "Assists": ("assistsSum", "assistsZScoreWeek"),
    "Steals": ("stealsSum", "stealsZScoreWeek"),
    "Blocks": ("blocksSum", "blocksZScoreWeek"),
    "Threes": ("threesSum", "threesZScoreWeek"),
    "Double-Doubles": ("doubleDoubleSum", "doubleDoubleZScoreWeek"),
    "eFG%": ("efgPctAvg", None),
    "FT%": ("ftPctAvg", None),
}


def ranked(z: DataFrame, season: DataFrame, n: int | None = None) -> DataFrame:
    """Players of the current season by total z, with their rank; unknown totals drop out.

    With ``n`` only the top of the list is built; without, every player is ranked by
    the distributed rank.
    """
    known = current_season_only(z, season).filter(F.col("totalZ").isNotNull())
    if n is None:
        out = rank_desc(known, "totalZ", rank="player_rank").orderBy("player_rank", "personId")
    else:
        out = rank_top(known, "totalZ", n, "player_rank", ["personId"])
    return out.select("player_rank", "firstName", "familyName", "totalZ", *Z_NAMES)


ranked_last10 = ranked
ranked_season = ranked


def order_by(df: DataFrame, c: str, ascending: bool = False) -> DataFrame:
    return df.orderBy(F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last())


def week_directory(weekly: DataFrame) -> DataFrame:
    """Distinct weeks with a label, oldest first."""
    cols = ["seasonId", "weekNumber", "weekStartDate", "weekEndDate", "seasonWeekId"]
    label = week_label("seasonId", "weekNumber", "weekStartDate", "weekEndDate")
    return weekly.select(*cols).distinct().withColumn("label", label).orderBy("seasonId", "weekNumber")


def latest_week(weekly: DataFrame) -> DataFrame:
    order = [F.col("seasonId").desc(), F.col("weekNumber").desc()]
    return top_n(weekly.select("seasonId", "weekNumber", "weekStartDate", "weekEndDate").distinct(), order, 1)


def week_rows(weekly: DataFrame, season: int | str, week: int | str) -> DataFrame:
    return weekly.filter(eq_intish("seasonId", season) & eq_intish("weekNumber", week))


def category_leaders(weekly: DataFrame) -> DataFrame:
    """Leader of each category for every week: by z where there is one, else by sum or mean.

    A category nobody has a value in reads ``N/A``.
    """
    ranking = {name: z or value for name, (value, z) in WEEK_CATEGORIES.items()}
    shown = {c for pair in WEEK_CATEGORIES.values() for c in pair if c}
    carry = ["personId", "firstName", "familyName", *sorted(shown)]
    best = leaders(weekly, ranking, ["seasonId", "weekNumber"], ["personId"], carry)

    def pick(which: int):
        out = F.lit(None).cast("double")
        for name, pair in WEEK_CATEGORIES.items():
            if pair[which]:
                out = F.when(F.col("category") == name, F.col(pair[which]).cast("double")).otherwise(out)
        return format_magnitude(out)

    name = F.coalesce(display_name("firstName", "familyName", "personId"), F.lit("N/A"))
    return best.select(
        "seasonId", "weekNumber", "category",
        name.alias("player"), pick(0).alias("value"), pick(1).alias("z_score"),
    )


def top_players(week: DataFrame, n: int = 25) -> DataFrame:
    """Top of one week by total z, or by the first counting column there is."""
    by = first_existing(week, ["totalZWeek", "pointsSum", "assistsSum", "reboundsSum"]) or week.columns[0]
    wanted = [
        "firstName", "familyName", "personId", "gamesPlayedWeek", "pointsSum", "assistsSum",
        "reboundsSum", "stealsSum", "blocksSum", "threesSum", "doubleDoubleSum", "totalZWeek",
    ]
    present = [c for c in (first_existing(week, [w]) for w in wanted) if c]
    order = [F.col(by).desc_nulls_last()]
    order += [F.col("personId").asc_nulls_last()] if "personId" in week.columns else []
    return top_n(week, order, n).select(*present)


def breakouts_from(weekly: DataFrame, season_means: DataFrame) -> DataFrame:
    """Weekly means minus season means per player: our own definition of a breakout table."""
    means = season_means.select("seasonId", "personId", "avg_minutes", "avg_points")
    return weekly.join(means, ["seasonId", "personId"]).select(
        "seasonId", "weekNumber", "weekStartDate", "personId", "firstName", "familyName",
        (F.col("minutesAvg") - F.col("avg_minutes")).alias("minutes_delta_week"),
        (F.col("pointsAvg") - F.col("avg_points")).alias("points_delta_week"),
    )


def weekly_breakouts(df: DataFrame, season: int | str, week: int | str, week_start=None) -> DataFrame:
    """One week of a breakout table, biggest gain in minutes first.

    Filters by week number if the table has one, else by week start; a table with
    neither yields no rows.
    """
    if first_existing(df, ["weekNumber"]):
        out = week_rows(df, season, week)
    elif first_existing(df, ["weekStartDate"]) and week_start is not None:
        out = df.filter(eq_intish("seasonId", season) & (F.col("weekStartDate") == F.lit(week_start)))
    else:
        return df.limit(0)
    gain = first_existing(out, ["minutes_delta_week"])
    return order_by(out, gain) if gain else out


def season_ranks(final: DataFrame, season: int | str) -> DataFrame:
    """Season sheet with dense ranks by both totals, best cumulative total first."""
    df = final.filter(eq_intish("seasonId", season))
    by = [c for c in ("zcum_total", "zavg_total") if first_existing(df, [c])]
    names = {"zcum_total": "cumulative_rank", "zavg_total": "average_rank"}
    if by:
        df = rank_each(df, {c: (None, names[c]) for c in by})
    return order_by(df, by[0]) if by else df
