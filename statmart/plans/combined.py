"""Raw text tables to typed facts: lines, team totals, team-games and player-games."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import first_of, try_date, try_double, try_long, zero_if_null
from statmart.functions.dates import date_from_int
from statmart.operators.joins import combine_chain, combine_star, link_columns, map_names
from statmart.session import limit_methods

from .measures import PLAYER_MEASURES, TEAM_MEASURES

# Source letter -> column prefix after the wide joins.
PREFIX = {"l": "", "t": "t_", "a": "a_", "f": "f_", "m": "m_", "s": "s_"}
SOURCE = {"t": "traditional", "a": "advanced", "f": "fourfactors", "m": "misc", "s": "scoring"}
TEAM_GROUP = ["gameid", "teamid", "teamcity", "teamname", "teamtricode", "teamslug"]


def _raw(ref: str) -> str:
    letter, col = ref.split(".")
    return PREFIX[letter] + col


def _narrow(df: DataFrame, letter: str, measures: dict[str, list[str]], texts: list[str]) -> DataFrame:
    """A source reduced to what the facts read from it, measures already typed.

    Typing before the joins makes each measure eight bytes in every shuffle and join
    row instead of text.
    """
    wanted = [x.split(".")[1] for refs in measures.values() for x in refs if x.startswith(f"{letter}.")]
    return df.selectExpr(*texts, *[f"try_cast({c} AS DOUBLE) AS {c}" for c in wanted])


def _typed(measures: dict[str, list[str]]) -> list[str]:
    """Each measure from the first source with a readable value, as SQL text."""
    def read(ref: str) -> str:
        return f"try_cast({_raw(ref)} AS DOUBLE)" if ref.startswith("l.") else _raw(ref)

    return [f"coalesce({', '.join(map(read, refs))}) AS {out}" for out, refs in measures.items()]


def _first_raw(letters: str, col: str, *before: str) -> Column:
    return first_of(*before, *[f"{PREFIX[x]}{col}" for x in letters])


def team_totals(trad: DataFrame) -> DataFrame:
    """One row per team-game from its starters and bench halves.

    Counts add up with unknown as 0; percentages are the plain mean of the halves;
    minutes is the greatest text.
    """
    skip = {*TEAM_GROUP, "minutes", "startersbench"}
    measures = [c for c in trad.columns if c not in skip]
    aggs = [
        F.avg(try_double(c)).alias(c) if c.endswith("percentage")
        else F.sum(zero_if_null(try_double(c))).alias(c)
        for c in measures
    ]
    return trad.groupBy(*TEAM_GROUP).agg(F.max("minutes").alias("minutes"), *aggs)


def current_season(log: DataFrame) -> DataFrame:
    """Greatest regular season id (those that start with 2), one row."""
    regular = log.filter(F.col("season_id").like("2%"))
    return regular.agg(F.max(F.col("season_id").cast("int")).alias("seasonId"))


def game_lines(lines: DataFrame, mapping: DataFrame, log: DataFrame) -> DataFrame:
    """Book lines attached to games by date and dictionary team name."""
    dated = lines.select(
        date_from_int("date").alias("p_date"), "team",
        try_double("line").alias("line"), try_double("total").alias("ou"),
    ).filter(F.col("p_date").isNotNull())
    named = map_names(dated, mapping, "team", "raw_data_team_name", "log_table_team_name", "log_name")
    games = log.select(
        F.col("game_id").alias("gameId"), try_date("game_date").alias("gameDate"),
        F.col("team_abbreviation").alias("teamTricode"), "team_name",
    ).filter(F.col("gameDate").isNotNull())
    cond = (games["gameDate"] == named["p_date"]) & (games["team_name"] == named["log_name"])
    return games.join(named, cond).select("gameId", "gameDate", "teamTricode", "line", "ou")


def teams_combined(log: DataFrame, sources: dict[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Typed team-game facts: the log with every team source attached by (game, team code).

    ``sources``: ``advanced``, ``fourfactors``, ``misc``, ``scoring`` raw tables and
    ``traditional`` already reduced by :func:`team_totals`.
    """
    limit_methods(log.sparkSession)
    texts = ["gameid", "teamid", "teamname", "teamcity", "teamtricode", "minutes"]
    named = {x: _narrow(sources[SOURCE[x]], x, TEAM_MEASURES, texts) for x in "aftsm"}
    named["b"] = lines
    keys = {x: {"k_game": try_long(f"{x}_gameid"), "k_team": F.col(f"{x}_teamtricode")} for x in "aftsm"}
    keys["b"] = {"k_game": try_long("b_gameId"), "k_team": F.col("b_teamTricode")}
    wide = combine_star(
        log, named, {"k_game": try_long("game_id"), "k_team": F.col("team_abbreviation")}, keys
    )
    order = "famst"
    game = first_of("game_id", "f_gameid", "b_gameId", *[f"{x}_gameid" for x in "amst"])
    return wide.select(
        game.alias("gameId"),
        first_of(try_date("game_date"), "b_gameDate").alias("gameDate"),
        first_of("team_abbreviation", "f_teamtricode", "b_teamTricode", *[f"{x}_teamtricode" for x in "amst"]).alias("teamTricode"),
        try_long("season_id").alias("seasonId"),
        _first_raw(order, "teamid", "team_id").alias("teamId"),
        _first_raw(order, "teamname", "team_name").alias("teamName"),
        _first_raw(order, "teamcity").alias("teamCity"),
        "matchup",
        F.col("wl").alias("winLoss"),
        try_double("plus_minus").alias("plusMinus"),
        try_double("b_line").alias("line"),
        try_double("b_ou").alias("overUnder"),
        try_double(_first_raw(order, "minutes", "min")).alias("minutes"),
        *map(F.expr, _typed(TEAM_MEASURES)),
    ).filter(F.col("gameDate").isNotNull())


NAMES = {
    "firstName": "firstname", "familyName": "familyname", "playerSlug": "playerslug",
    "position": "position", "comment": "comment", "teamCity": "teamcity", "minutes": "minutes",
}


def _print(cols: list[str]) -> Column:
    """One number for the values of ``cols``, NULLs told apart by place."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def players_combined(log: DataFrame, tables: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Typed player-game facts, whole-row distinct.

    Each player table is matched on the keys of the one before it (traditional,
    advanced, four factors, scoring, misc), so a gap in one hides the later ones.

    ``columns`` leaves the other columns out of the result, not out of the distinct: its rows are
    those of the whole facts. What is left out goes through the joins and the distinct as 64-bit
    hashes, which only rows of the same game, team and person are compared by.
    """
    limit_methods(log.sparkSession)
    wanted = lambda c: columns is None or c in columns
    refs = {x: [r.split(".")[1] for rs in PLAYER_MEASURES.values() for r in rs if r.startswith(f"{x}.")] for x in "tafsm"}
    # Measures that only one table has can be hashed where they are read, all in one.
    lone = {x: [r[0].split(".")[1] for c, r in PLAYER_MEASURES.items() if not wanted(c) and len(r) == 1 and r[0].startswith(f"{x}.")] for x in "tafsm"}
    kept = {c: r for c, r in PLAYER_MEASURES.items() if wanted(c) or len(r) > 1}

    def source(x: str) -> DataFrame:
        texts = ["gameid", "personid", *NAMES.values(), *(["teamtricode"] if x == "t" else [])]
        side = tables[SOURCE[x]].selectExpr(*texts, *[f"try_cast({c} AS DOUBLE) AS {c}" for c in refs[x]])
        hashed = {raw: F.when(F.col(raw).isNotNull(), F.xxhash64(raw)) for c, raw in NAMES.items() if not wanted(c)}
        if lone[x]:
            hashed["rest"] = _print(lone[x])
        return side.withColumns(hashed).drop(*lone[x])

    chain = [(x, source(x)) for x in "tafsm"]
    links = {"game": "gameid", "person": "personid"}
    wide = combine_chain(
        log,
        chain,
        first_keys=(
            {"game": try_long("game_id"), "team": F.col("team_abbreviation")},
            {"game": try_long("t_gameid"), "team": F.col("t_teamtricode")},
        ),
        link_keys=links,
        keep_links=True,
    )
    # Both follow from a row's game, team and person, so they tell no rows apart; with them among
    # its keys the distinct runs where the joins have put the rows.
    laid = link_columns(chain, links)
    order = "famst"
    typed = wide.select(
        try_long("season_id").alias("seasonId"),
        try_long("team_id").alias("teamId"),
        F.col("team_abbreviation").alias("teamAbbreviation"),
        F.col("team_name").alias("teamName"),
        F.col("game_id").alias("gameId"),
        try_date("game_date").alias("gameDate"),
        "matchup",
        F.col("wl").alias("winLoss"),
        # Every table's person equals the first one's, or there is no row of that table.
        F.col(laid[1]).alias("personId"),
        *[_first_raw(order, raw).alias(out) for out, raw in NAMES.items()],
        *map(F.expr, _typed(kept)),
        *[f"{PREFIX[x]}rest" for x in lone if lone[x]],
        *laid,
    ).filter(F.col("gameDate").isNotNull())
    if columns is None:
        return typed.distinct().drop(*laid)
    left_out = [c for c in typed.columns if c not in columns and c not in laid]
    return typed.select(*columns, _print(left_out).alias("__rest"), *laid).distinct().select(*columns)
