"""Column names of the raw tables and the all-text schemas built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw column names, in table order ---------------------------

LOG = (
    "season_id team_id team_abbreviation team_name game_id game_date matchup wl min pts fgm fga "
    "fg_pct fg3m fg3a fg3_pct ftm fta ft_pct oreb dreb reb ast stl blk tov pf plus_minus"
).split()
TEAM_PREFIX = "gameid teamid teamcity teamname teamtricode teamslug".split()
PLAYER_PREFIX = (
    "personid firstname familyname namei playerslug position comment jerseynum"
).split()
ADVANCED = (
    "estimatedoffensiverating offensiverating estimateddefensiverating defensiverating "
    "estimatednetrating netrating assistpercentage assisttoturnover assistratio "
    "offensivereboundpercentage defensivereboundpercentage reboundpercentage turnoverratio "
    "effectivefieldgoalpercentage trueshootingpercentage usagepercentage "
    "estimatedusagepercentage estimatedpace pace paceper40 possessions pie"
).split()
FOURFACTORS = (
    "effectivefieldgoalpercentage freethrowattemptrate teamturnoverpercentage "
    "offensivereboundpercentage oppeffectivefieldgoalpercentage oppfreethrowattemptrate "
    "oppteamturnoverpercentage oppoffensivereboundpercentage"
).split()
MISC = (
    "pointsoffturnovers pointssecondchance pointsfastbreak pointspaint opppointsoffturnovers "
    "opppointssecondchance opppointsfastbreak opppointspaint blocks blocksagainst "
    "foulspersonal foulsdrawn"
).split()
SCORING = (
    "percentagefieldgoalsattempted2pt percentagefieldgoalsattempted3pt percentagepoints2pt "
    "percentagepointsmidrange2pt percentagepoints3pt percentagepointsfastbreak "
    "percentagepointsfreethrow percentagepointsoffturnovers percentagepointspaint "
    "percentageassisted2pt percentageunassisted2pt percentageassisted3pt "
    "percentageunassisted3pt percentageassistedfgm percentageunassistedfgm"
).split()
TRADITIONAL = (
    "fieldgoalsmade fieldgoalsattempted fieldgoalspercentage threepointersmade "
    "threepointersattempted threepointerspercentage freethrowsmade freethrowsattempted "
    "freethrowspercentage reboundsoffensive reboundsdefensive reboundstotal assists steals "
    "blocks turnovers foulspersonal points"
).split()

# ------------------------------------------------------------------------------

ENDPOINTS = {
    "advanced": ADVANCED,
    "fourfactors": FOURFACTORS,
    "misc": MISC,
    "scoring": SCORING,
    "traditional": TRADITIONAL,
}
# Columns only one of the two tables of an endpoint has.
TEAM_EXTRA = {"advanced": ["estimatedteamturnoverpercentage"], "traditional": ["startersbench"]}
PLAYER_EXTRA = {"traditional": ["plusminuspoints"]}


def text_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def raw_columns(endpoint: str, is_team: bool) -> list[str]:
    person = [] if is_team else PLAYER_PREFIX
    extra = (TEAM_EXTRA if is_team else PLAYER_EXTRA).get(endpoint, [])
    return [*TEAM_PREFIX, *person, "minutes", *ENDPOINTS[endpoint], *extra]


LINES_SCHEMA = T.StructType(
    [
        T.StructField("date", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("team", "site", "o:team")],
        *[T.StructField(c, T.DoubleType()) for c in ("line", "total")],
    ]
)
MAPPING_SCHEMA = text_schema(["raw_data_team_name", "log_table_team_name"])

RAW_SCHEMAS: dict[str, T.StructType] = {
    "lines_table": LINES_SCHEMA,
    "log_table": text_schema(LOG),
    **{f"players_{e}": text_schema(raw_columns(e, False)) for e in ENDPOINTS},
    **{f"teams_{e}": text_schema(raw_columns(e, True)) for e in ENDPOINTS},
}
