"""Oracle SQL of the domain marts, generated from the measure lists. DuckDB dialect."""

from __future__ import annotations

from statmart.plans import measures as m
from statmart.plans.fantasy import COUNTED, DELTA_SOURCES, SHORT, WEEK_Z, Z_NAMES
from statmart.plans.processed import TEAM_CONTEXT
from statmart.sources.schemas import TRADITIONAL

from .inputs import r, raw_ctes

TEAM_SRC = {"l": "l", "t": "tt", "a": "ta", "f": "tf", "m": "tm", "s": "ts"}
PLAYER_SRC = {"t": "pt", "a": "pa", "f": "pf", "m": "pm", "s": "ps"}


def _num(refs: list[str], alias: dict[str, str]) -> str:
    casts = [f"TRY_CAST({alias[x.split('.')[0]]}.{x.split('.')[1]} AS DOUBLE)" for x in refs]
    return casts[0] if len(casts) == 1 else f"COALESCE({', '.join(casts)})"


def _big(c: str) -> str:
    return f"TRY_CAST({c} AS BIGINT)"


def _totals() -> str:
    parts = []
    for c in TRADITIONAL:
        x = f"TRY_CAST({c} AS DOUBLE)"
        parts.append(f"AVG({x}) AS {c}" if c.endswith("percentage") else f"SUM(COALESCE({x}, 0)) AS {c}")
    keys = "gameid, teamid, teamcity, teamname, teamtricode, teamslug"
    return f"SELECT {keys}, MAX(minutes) AS minutes, {', '.join(parts)} FROM teams_traditional GROUP BY {keys}"


def _first(col: str, *before: str, order: tuple[str, ...] = ("tf", "ta", "tm", "ts", "tt")) -> str:
    return f"COALESCE({', '.join([*before, *[f'{x}.{col}' for x in order]])})"


def _teams_combined() -> str:
    cols = ", ".join(f"{_num(src, TEAM_SRC)} AS {c}" for c, src in m.TEAM_MEASURES.items())
    joins = " ".join(
        f"LEFT JOIN {tab} {a} ON {_big('l.game_id')} = {_big(f'{a}.gameid')} AND l.team_abbreviation = {a}.teamtricode"
        for a, tab in [("ta", "teams_advanced"), ("tf", "teams_fourfactors"), ("tt", "totals"),
                       ("ts", "teams_scoring"), ("tm", "teams_misc"), ("bl", "game_lines")]
    )
    return f"""SELECT * FROM (SELECT l.game_id AS gameId, COALESCE(TRY_CAST(l.game_date AS DATE), bl.gameDate) AS gameDate,
      l.team_abbreviation AS teamTricode, {_big('l.season_id')} AS seasonId, {_first('teamid', 'l.team_id')} AS teamId,
      {_first('teamname', 'l.team_name')} AS teamName, {_first('teamcity')} AS teamCity, l.matchup AS matchup,
      l.wl AS winLoss, TRY_CAST(l.plus_minus AS DOUBLE) AS plusMinus, bl.line AS line, bl.ou AS overUnder,
      TRY_CAST({_first('minutes', 'l.min')} AS DOUBLE) AS minutes, {cols}
      FROM log_table l {joins}) WHERE gameDate IS NOT NULL"""


def _players_combined() -> str:
    order = ("pf", "pa", "pm", "ps", "pt")
    cols = ", ".join(f"{_num(src, PLAYER_SRC)} AS {c}" for c, src in m.PLAYER_MEASURES.items())
    texts = ", ".join(
        f"{_first(raw, order=order)} AS {out}"
        for out, raw in [("firstName", "firstname"), ("familyName", "familyname"), ("playerSlug", "playerslug"),
                         ("position", "position"), ("comment", "comment"), ("teamCity", "teamcity"), ("minutes", "minutes")]
    )
    links = " ".join(
        f"LEFT JOIN players_{tab} {b} ON {_big(f'{a}.gameid')} = {_big(f'{b}.gameid')} AND {_big(f'{a}.personid')} = {_big(f'{b}.personid')}"
        for a, b, tab in [("pt", "pa", "advanced"), ("pa", "pf", "fourfactors"), ("pf", "ps", "scoring"), ("ps", "pm", "misc")]
    )
    return f"""SELECT DISTINCT {_big('l.season_id')} AS seasonId, {_big('l.team_id')} AS teamId,
      l.team_abbreviation AS teamAbbreviation, l.team_name AS teamName, l.game_id AS gameId,
      TRY_CAST(l.game_date AS DATE) AS gameDate, l.matchup AS matchup, l.wl AS winLoss,
      {_big(_first('personid', order=order))} AS personId, {texts}, {cols}
      FROM log_table l LEFT JOIN players_traditional pt
        ON {_big('l.game_id')} = {_big('pt.gameid')} AND l.team_abbreviation = pt.teamtricode
      {links} WHERE TRY_CAST(l.game_date AS DATE) IS NOT NULL"""


def _teams_processed() -> str:
    season = "PARTITION BY t.teamId, t.seasonId"
    kind = f"{season}, t.seasonType"
    by = "ORDER BY t.gameDate, t.gameId"
    hit = "SUM(CASE WHEN t.winLoss = '{}' THEN 1 ELSE 0 END)"
    near = "(SELECT COUNT(*) FROM outc o WHERE o.teamId = t.teamId AND o.seasonId = t.seasonId AND o.gameDate BETWEEN t.gameDate - INTERVAL {} DAY AND t.gameDate)"
    vs = f"{kind}, t.opponentTricode {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    extra = ", ".join(f"t.{c}" for c in m.TEAM_OUTPUT)
    return f"""SELECT t.gameId, LEAD(t.gameId) OVER ({season} {by}) AS nextGameId, t.gameDate, t.seasonId, t.seasonType,
      t.teamId, t.teamTricode, t.teamName, t.teamCity, t.homeTeam, t.awayTeam, t.homeGame, t.matchup,
      ROW_NUMBER() OVER ({season} {by}) AS gameNumber,
      date_diff('day', LAG(t.gameDate) OVER ({season} {by}), t.gameDate) AS daysSinceLastGame,
      CASE WHEN date_diff('day', LAG(t.gameDate) OVER ({season} {by}), t.gameDate) = 1 THEN 1 ELSE 0 END AS isBackToBack,
      CASE WHEN {near.format(3)} >= 3 THEN 1 ELSE 0 END AS is3In4,
      CASE WHEN {near.format(5)} >= 4 THEN 1 ELSE 0 END AS is4In6,
      CASE WHEN t.gameDate = MAX(t.gameDate) OVER ({season}) THEN 1 ELSE 0 END AS isLastTeamGame,
      t.line, t.overUnder, t.winLoss, t.points, t.opponentPoints, t.points + t.opponentPoints AS totalPoints,
      t.scoreDiff, t.coverResult, t.overUnderResult,
      CAST({hit.format('W')} OVER ({kind} {by} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS winsSoFar,
      CAST({hit.format('L')} OVER ({kind} {by} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS lossesSoFar,
      ROUND(CAST({hit.format('W')} OVER ({kind} {by} ROWS 9 PRECEDING) AS DOUBLE)
        / LEAST(10, ROW_NUMBER() OVER ({kind} {by})), 3) AS last10WinPercentage,
      CAST({hit.format('W')} OVER ({vs}) AS BIGINT) AS winsVsOpponent,
      CAST({hit.format('L')} OVER ({vs}) AS BIGINT) AS lossesVsOpponent, {extra} FROM outc t"""


def cover_sql(margin: str, home: str, line: str) -> str:
    """A side covers if its margin and the line, which is the home side's, add up to more than nothing."""
    return f"['No Cover', 'No Cover', 'Cover'][2 + CAST(sign({margin} + {line} * (2 * CAST({home} AS INTEGER) - 1)) AS INTEGER)]"


def over_under_sql(points: str, bar: str) -> str:
    """Which side of the bar the points are; unknown points are on neither, without a bar there is no side."""
    return f"['Under', 'Push', 'Over'][CAST({bar} * 0 + 2 + coalesce(sign({points} - {bar}), 0) AS INTEGER)]"


#: A match-up names the own side first; the marker between the two says who is at home.
SIDES = r"string_split_regex({m}, ' *(vs\.|@) *')"


def side_sql(matchup: str, own_is_home: str, home: bool) -> str:
    sides = SIDES.format(m=matchup)
    return f"{sides}[CASE WHEN {own_is_home} = {str(home).lower()} THEN 1 ELSE 2 END]"


SEASON_KIND = "coalesce(MAP {{'4': 'PLAYOFFS', '6': 'NBA_CUP'}}[left(CAST({s} AS VARCHAR), 1)], 'REGULAR')"

VENUE = f"""SELECT *, {SEASON_KIND.format(s='seasonId')} AS seasonType, coalesce(plusMinus, 0) AS scoreDiff,
  {side_sql('matchup', 'homeGame', True)} AS homeTeam, {side_sql('matchup', 'homeGame', False)} AS awayTeam, {SIDES.format(m='matchup')}[2] AS opponentTricode
  FROM (SELECT *, contains(matchup, ' vs. ') AS homeGame FROM teams_combined)"""

OUTCOMES = f"""SELECT own.*, other.points AS opponentPoints, {cover_sql('own.scoreDiff', 'own.homeGame', 'own.line')} AS coverResult,
  {over_under_sql('own.points + other.points', 'own.overUnder')} AS overUnderResult
  FROM venue own JOIN teams_combined other ON own.gameId = other.gameId AND own.teamId <> other.teamId"""

LINES = """SELECT g.game_id AS gameId, TRY_CAST(g.game_date AS DATE) AS gameDate, g.team_abbreviation AS teamTricode,
  x.line AS line, x.total AS ou
  FROM lines_table x JOIN line_team_mapping mp ON mp.raw_data_team_name = x.team
  JOIN log_table g ON g.team_name = mp.log_table_team_name
    AND TRY_CAST(g.game_date AS DATE) = CAST(strptime(CAST(x.date AS VARCHAR), '%Y%m%d') AS DATE)"""


def _players_processed() -> str:
    w = "PARTITION BY p.personId, p.seasonId"
    by = "ORDER BY p.gameDate, p.gameId"
    mins, secs = "TRY_CAST(split_part(clock, ':', 1) AS DOUBLE)", "TRY_CAST(split_part(clock, ':', 2) AS DOUBLE)"
    own = "seasonId teamId teamAbbreviation teamName gameId gameDate teamCity personId firstName familyName playerSlug position comment matchup winLoss".split()
    return f"""SELECT {', '.join(f'p.{c}' for c in own)}, LEAD(p.gameId) OVER ({w} {by}) AS nextGameId,
      ROW_NUMBER() OVER ({w} {by}) AS gameCount, p.playedFlag,
      CAST(SUM(p.playedFlag) OVER ({w} {by} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gamesPlayed,
      CASE WHEN p.playedFlag = 1 AND ROW_NUMBER() OVER ({w} ORDER BY p.playedFlag DESC, p.gameDate DESC, p.gameId DESC) = 1
           THEN 1 ELSE 0 END AS isLastGame, p.mins AS minutes,
      {', '.join(f'p.{c}' for c in m.PLAYER_OUTPUT)}, {', '.join(f't.{c}' for c in TEAM_CONTEXT)}
      FROM (SELECT *, COALESCE({mins} + {secs} / 60, 0) AS mins,
              CASE WHEN {mins} > 0 OR {secs} > 0 THEN 1 ELSE 0 END AS playedFlag
            FROM (SELECT *, CASE WHEN COALESCE(minutes, '') = '' THEN '00:00' ELSE minutes END AS clock FROM players_combined)) p
      LEFT JOIN teams_processed t ON p.gameId = t.gameId AND p.teamId = TRY_CAST(t.teamId AS BIGINT)
      WHERE p.personId IS NOT NULL"""


TEAM_AVG_KEEP = (
    "gameId gameDate seasonId seasonType teamId teamTricode teamName teamCity homeTeam awayTeam homeGame matchup gameNumber "
    "daysSinceLastGame isBackToBack is3In4 is4In6 isLastTeamGame winLoss coverResult overUnderResult"
).split()
TEAM_AVG_NUM = "line overUnder points opponentPoints totalPoints scoreDiff".split()
PLAYER_AVG_KEEP = (
    "seasonId teamId teamAbbreviation teamName teamCity gameId nextGameId gameDate personId firstName familyName playerSlug "
    "position comment gameCount playedFlag gamesPlayed isLastGame matchup winLoss"
).split() + [c for c in TEAM_CONTEXT if c != "last10WinPercentage"]
GAME = "seasonId gameId gameDate firstName familyName personId playedFlag isLastGame".split()


def _expanding(pairs: dict[str, str], keep: list[str], source: str, who: str) -> str:
    w = f"OVER (PARTITION BY {who}, seasonId ORDER BY gameDate, gameId ROWS UNBOUNDED PRECEDING)"
    return f"SELECT {', '.join(keep)}, {', '.join(f'AVG({e}) {w} AS {o}' for o, e in pairs.items())} FROM {source}"


def _played(c: str) -> str:
    return f"CASE WHEN playedFlag = 1 THEN {c} END"


def _z(source: str, cols: list[str], carry: list[str]) -> str:
    z = ", ".join(
        f"({c} - AVG({c}) OVER (PARTITION BY seasonId)) / NULLIF(STDDEV_SAMP({c}) OVER (PARTITION BY seasonId), 0) AS {out}"
        for out, c in zip(Z_NAMES, cols)
    )
    total = " + ".join(x for x in Z_NAMES if x != "minutesZScore")
    return f"SELECT *, {total} AS totalZ FROM (SELECT seasonId, personId, {', '.join(carry)}, {z} FROM {source})"


NAMES = ["firstName", "familyName"]
AVGS = [a for _, a in m.CATEGORIES.values()]
CUMS = [f"{x}Cumulative" for x in COUNTED.values()] + ["avgEfgPct", "avgFtPct"]
MEAN_OF = {**{c: x for c, x in COUNTED.items() if x != "doubleDouble"},
           "effectiveFieldGoalPercentage": "efgPct", "freeThrowsPercentage": "ftPct"}
WEEK_PLAIN = "personId firstName familyName seasonId weekNumber weekStartDate weekEndDate seasonWeekId gamesPlayedWeek".split()
WEEK_NUM = [f"{x}Sum" for x in COUNTED.values()] + [f"{x}Avg" for x in MEAN_OF.values()] + WEEK_Z + ["totalZWeek"]


def _weekly() -> str:
    sums = ", ".join(f"SUM({_played(c)}) AS {x}Sum" for c, x in COUNTED.items())
    means = ", ".join(f"AVG({_played(c)}) AS {x}Avg" for c, x in MEAN_OF.items())
    agg = f"""SELECT personId, firstName, familyName, seasonId, CAST(date_trunc('week', gameDate) AS DATE) AS weekStartDate,
      COUNT(*) FILTER (WHERE playedFlag = 1) AS gamesPlayedWeek, {sums}, {means}
      FROM base_stats WHERE seasonId = (SELECT seasonId FROM current_season)
      GROUP BY personId, firstName, familyName, seasonId, CAST(date_trunc('week', gameDate) AS DATE)"""
    w = "OVER (PARTITION BY seasonId, weekStartDate)"
    z = ", ".join(
        f"({x}Sum - AVG({x}Sum) {w}) / NULLIF(STDDEV_SAMP({x}Sum) {w}, 0) AS {x}ZScoreWeek"
        for x in COUNTED.values() if x != "minutes"
    )
    return f"""SELECT *, {' + '.join(WEEK_Z)} AS totalZWeek FROM (SELECT *,
      CAST(weekStartDate + INTERVAL 6 DAY AS DATE) AS weekEndDate,
      CAST(seasonId AS VARCHAR) || '_' || strftime(weekStartDate, '%G-%V') AS seasonWeekId,
      DENSE_RANK() OVER (PARTITION BY seasonId ORDER BY weekStartDate) AS weekNumber, {z} FROM ({agg}))"""


SNAKE = dict(zip(SHORT, ["minutes", "points", "assists", "steals", "blocks", "rebounds", "threes",
                         "double_double", "efg_pct", "ft_pct"]))
FINAL_AVG = {a: f"avg_{SNAKE[x]}" for x, a in m.CATEGORIES.values() if x != "doubleDouble"}
FINAL_CUM = {**{f"{x}Cumulative": f"cum_{SNAKE[x]}" for x in COUNTED.values()},
             "avgEfgPct": "cum_avg_efg_pct", "avgFtPct": "cum_avg_ft_pct"}
FINAL_ZA = {**{f"{x}ZScore": f"zavg_{SNAKE[x]}" for x in SHORT if x != "minutes"}, "totalZ": "zavg_total"}
FINAL_ZC = {**{f"{x}ZScore": f"zcum_{SNAKE[x]}" for x in SHORT}, "totalZ": "zcum_total"}
FINAL_NUM = [*FINAL_AVG.values(), *FINAL_CUM.values(), *FINAL_ZA.values(), *FINAL_ZC.values()]


def _final() -> str:
    def now(t: str) -> str:
        return f"(SELECT * FROM {t} WHERE seasonId = (SELECT seasonId FROM current_season))"

    cols = ", ".join(
        f"{a}.{c} AS {o}"
        for a, part in (("a", FINAL_AVG), ("c", FINAL_CUM), ("za", FINAL_ZA), ("zc", FINAL_ZC))
        for c, o in part.items()
    )
    who = "COALESCE(a.{0}, za.{0}, c.{0}, zc.{0}) AS {0}"
    return f"""SELECT {', '.join(who.format(x) for x in ['seasonId', 'personId', *NAMES])}, c.gamesPlayed AS gamesPlayed, {cols}
      FROM {now('averages_current')} a FULL JOIN {now('z_averages')} za ON a.seasonId = za.seasonId AND a.personId = za.personId
      FULL JOIN {now('season_cumulative')} c ON COALESCE(a.seasonId, za.seasonId) = c.seasonId AND COALESCE(a.personId, za.personId) = c.personId
      FULL JOIN {now('z_cumulative')} zc ON COALESCE(a.seasonId, za.seasonId, c.seasonId) = zc.seasonId
        AND COALESCE(a.personId, za.personId, c.personId) = zc.personId"""


_IN = {"rebounds": "reboundsTotal", "threes": "threePointersMade"}
DELTA_KEEP = "seasonId gameId gameDate personId firstName familyName playedFlag".split()
DELTA_NUM = (
    "minutes points assists steals blocks reboundsTotal threePointersMade".split() + list(DELTA_SOURCES.values())
    + [f"{x}_last3" for x in DELTA_SOURCES] + [f"{x}_delta" for x in DELTA_SOURCES] + ["pickup_score"]
)


def _delta() -> str:
    last = ", ".join(
        f"AVG({_IN.get(x, x)}) OVER (PARTITION BY personId ORDER BY gameDate, gameId ROWS 2 PRECEDING) AS {x}_last3"
        for x in DELTA_SOURCES
    )
    deltas = ", ".join(f"{x}_last3 - {a} AS {x}_delta" for x, a in DELTA_SOURCES.items())
    score = ("0.40 * minutes_delta + 0.30 * points_delta + 0.15 * assists_delta + 0.10 * rebounds_delta "
             "+ 0.05 * (steals_delta + blocks_delta)")
    return f"""SELECT *, {score} AS pickup_score FROM (SELECT j.*, {deltas} FROM (
      SELECT b.*, {', '.join(f'a.{c}' for c in DELTA_SOURCES.values())} FROM (SELECT *, {last} FROM base_stats) b
      LEFT JOIN averages a ON b.personId = a.personId AND b.gameId = a.gameId) j) WHERE playedFlag = 1"""


LOW = {z: z.lower() for z in Z_NAMES}


def _overall() -> str:
    top = "(SELECT MAX(seasonId) FROM z_cumulative)"

    def newest(t: str) -> str:
        return f"""(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY seasonId, personId ORDER BY gameDate DESC NULLS LAST) AS rn
          FROM {t} WHERE seasonId = {top}) WHERE rn = 1)"""

    cols = ", ".join(f"a.{z} AS avg_{x}, c.{z} AS cum_{x}" for z, x in LOW.items())
    return f"""SELECT c.seasonId AS seasonid, CAST(c.personId AS VARCHAR) AS personid, COALESCE(c.firstName, a.firstName) AS firstname,
      COALESCE(c.familyName, a.familyName) AS familyname, a.gameDate AS avg_gamedate, n.gameDate AS last10_gamedate,
      c.totalZ AS cum_totalz, a.totalZ AS avg_totalz, n.totalZ AS last_10_totalz, {cols}
      FROM (SELECT * FROM z_cumulative WHERE seasonId = {top}) c
      LEFT JOIN {newest('z_averages')} a ON a.seasonId = c.seasonId AND a.personId = c.personId
      LEFT JOIN {newest('z_last10')} n ON n.seasonId = c.seasonId AND n.personId = c.personId"""


BASE = f"""SELECT {', '.join(GAME)}, minutes, points, assists, steals, blocks, reboundsTotal, threePointersMade,
  effectiveFieldGoalPercentage, CASE WHEN freeThrowsAttempted = 0 THEN NULL ELSE freeThrowsPercentage END AS freeThrowsPercentage,
  CASE WHEN (points >= 10 OR assists >= 10 OR reboundsTotal >= 10)
    AND (CASE WHEN points >= 10 THEN 1 ELSE 0 END + CASE WHEN assists >= 10 THEN 1 ELSE 0 END + CASE WHEN reboundsTotal >= 10 THEN 1 ELSE 0 END
       + CASE WHEN steals >= 10 THEN 1 ELSE 0 END + CASE WHEN blocks >= 10 THEN 1 ELSE 0 END) >= 2 THEN 1 ELSE 0 END AS doubleDouble
  FROM players_processed"""

CUM = f"""SELECT seasonId, personId, MAX(firstName) AS firstName, MAX(familyName) AS familyName,
  COUNT(*) FILTER (WHERE playedFlag = 1) AS gamesPlayed, {', '.join(f'SUM({_played(c)}) AS {x}Cumulative' for c, x in COUNTED.items())},
  AVG({_played('effectiveFieldGoalPercentage')}) AS avgEfgPct, AVG({_played('freeThrowsPercentage')}) AS avgFtPct
  FROM base_stats WHERE seasonId = (SELECT seasonId FROM current_season) GROUP BY seasonId, personId"""


def _last10() -> str:
    w = "PARTITION BY seasonId, personId ORDER BY gameDate, gameId ROWS 9 PRECEDING"
    cols = ", ".join(f"AVG({c}) OVER ({w}) AS {o}" for c, o in m.LAST10_NAMES.items())
    return f"SELECT * FROM (SELECT {', '.join(GAME)}, {cols}, COUNT(*) OVER ({w}) AS games_in_window FROM base_stats) WHERE games_in_window >= 10"


MODELS = {
    "current_season": "SELECT MAX(CAST(season_id AS INTEGER)) AS seasonId FROM log_table WHERE season_id LIKE '2%'",
    "totals": _totals(),
    "game_lines": LINES,
    "teams_combined": _teams_combined(),
    "players_combined": _players_combined(),
    "venue": VENUE,
    "outc": OUTCOMES,
    "teams_processed": _teams_processed(),
    "players_processed": _players_processed(),
    "team_averages": _expanding({m.average_name(c, True): c for c in m.TEAM_AVERAGED}, TEAM_AVG_KEEP + TEAM_AVG_NUM, "teams_processed", "teamId"),
    "player_averages": _expanding(
        {"average_played_flag": "playedFlag", **{m.average_name(c, False): _played(c) for c in m.PLAYER_AVERAGED}},
        [*PLAYER_AVG_KEEP, "last10WinPercentage"], "players_processed", "personId"),
    "base_stats": BASE,
    "averages": _expanding({"average_played_flag": "playedFlag", **{a: _played(c) for c, (_, a) in m.CATEGORIES.items()}}, GAME, "base_stats", "personId"),
    "averages_current": "SELECT * FROM averages WHERE isLastGame = 1",
    "averages_last_10": _last10(),
    "averages_last_10_current": "SELECT * FROM averages_last_10 WHERE isLastGame = 1",
    "season_cumulative": CUM,
    "z_averages": _z("averages_current", AVGS, [*NAMES, "gameDate"]),
    "z_last10": _z("averages_last_10_current", list(m.LAST10_NAMES.values()), [*NAMES, "gameDate"]),
    "z_cumulative": _z("season_cumulative", CUMS, NAMES),
    "weekly_stats": _weekly(),
    "z_overall": _overall(),
    "season_final": _final(),
    "performance_delta": _delta(),
    "player_z": "SELECT z.*, n.totalZ AS last_10_z FROM z_averages z JOIN averages_current a ON z.personId = a.personId AND z.gameDate = a.gameDate "
                "JOIN z_last10 n ON z.personId = n.personId AND z.gameDate = n.gameDate",
}


def model_sql(name: str, select: str, until: str | None = None, extra: dict[str, str] | None = None) -> str:
    """``select`` over the model chain up to ``name``."""
    parts = []
    for n, sql in MODELS.items():
        parts.append(f"{n} AS ({sql})")
        if n == (until or name):
            break
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {raw_ctes()}, {', '.join(parts)} {select}"


def final(name: str, plain: list[str], nums: list[str]) -> str:
    return model_sql(name, f"SELECT {', '.join([*plain, *[r(c) for c in nums]])} FROM {name}")
