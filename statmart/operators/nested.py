"""Nested roster documents: map of team to array of player objects, and back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.casts import try_double, try_long

# Keys of the nine-category map and the columns they become.
NINE_CATEGORIES = {
    "PTS": "nine_pts",
    "REB": "nine_reb",
    "AST": "nine_ast",
    "STL": "nine_stl",
    "BLK": "nine_blk",
    "TO": "nine_to",
    "3PM": "nine_3pm",
    "FG%": "nine_fgpct",
    "FT%": "nine_ftpct",
}

_TEXT_FIELDS = ["playerId", "name", "position", "proTeam", "acquisitionType"]
_POINT_FIELDS = ["avg_points", "total_points", "projected_avg_points", "projected_total_points"]

# Numbers are read as text and typed afterwards, so one malformed value costs one field.
PLAYER_STRUCT = T.StructType(
    [T.StructField(f, T.StringType()) for f in _TEXT_FIELDS]
    + [T.StructField("injured", T.BooleanType()), T.StructField("injuryStatus", T.StringType())]
    + [T.StructField(f, T.StringType()) for f in [*_POINT_FIELDS, "posRank"]]
    + [T.StructField("nine_cat_averages", T.MapType(T.StringType(), T.StringType()))]
)
ROSTERS = T.MapType(T.StringType(), T.ArrayType(PLAYER_STRUCT))
ROSTER_IDS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def expand_map(c: str, keys: dict[str, str]) -> list[Column]:
    """One column per key of a map column; a missing map or key gives NULL."""
    return [
        try_double(F.try_element_at(F.col(c), F.lit(k))).alias(out) for k, out in keys.items()
    ]


def flatten_rosters(df: DataFrame, snapshot_date: date | Column, c: str = "rosters") -> DataFrame:
    """One typed row per player of a ``ROSTERS`` map column."""
    day = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    players = df.select(day.cast("date").alias("snapshot_date"), F.explode(c).alias("fantasy_team", "ps"))
    rows = players.select("snapshot_date", "fantasy_team", F.explode("ps").alias("p"))
    return rows.select(
        "snapshot_date",
        "fantasy_team",
        try_long("p.playerId").alias("playerId"),
        "p.name", "p.position", "p.proTeam", "p.acquisitionType", "p.injured", "p.injuryStatus",
        *[try_double(f"p.{f}").alias(f) for f in _POINT_FIELDS],
        try_long("p.posRank").cast("int").alias("posRank"),
        *expand_map("p.nine_cat_averages", NINE_CATEGORIES),
    )


def parse_rosters(df: DataFrame, c: str = "value", out: str = "rosters") -> DataFrame:
    """Read JSON text as the roster map (team names stay data, not field names)."""
    return df.select(F.from_json(c, ROSTERS).alias(out))


def parse_roster_ids(df: DataFrame, c: str = "value") -> DataFrame:
    """Two columns (team, ids as text) from JSON of team to id list."""
    return df.select(F.explode(F.from_json(c, ROSTER_IDS)).alias("team", "ids"))


def nest_rosters(df: DataFrame, team: str, player: Column, order: list[str] = (), roster: list[str] = ()) -> DataFrame:
    """One JSON document ``{team: [player, ...], ...}`` per roster set, from flat rows.

    ``roster`` names the columns that tell sets apart (they are kept); a set is one document by its
    nature and its size bounds the group. Players stand in ``order`` (ties by the player's own
    values) and teams by name, so a document does not depend on how the rows were dealt. Two
    stages: players into teams, then teams into documents. Rows without a team are left out.
    """
    # Players become text first: any value can then be sorted and put into a document.
    entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], _json(player).alias("p"))
    marked = df.filter(F.col(team).isNotNull()).select(*roster, F.col(team).cast("string").alias("__team"), entry.alias("__e"))
    teams = marked.groupBy(*roster, "__team").agg(F.sort_array(F.collect_list("__e")).alias("__ps"))
    players = F.array_join(F.transform("__ps", lambda e: e["p"]), ",")
    lines = F.struct("__team", F.concat(_json(F.col("__team")), F.lit(":["), players, F.lit("]")).alias("line"))
    sets = teams.groupBy(*roster).agg(F.sort_array(F.collect_list(lines)).alias("__ts"))
    document = F.concat(F.lit("{"), F.array_join(F.transform("__ts", lambda t: t["line"]), ","), F.lit("}"))
    return sets.filter(F.size("__ts") > 0).select(*roster, document.alias("value"))


def _json(c: Column) -> Column:
    """Any value as JSON text."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)
