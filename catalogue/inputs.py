"""Domain-shaped inputs derived from the provided tables by SQL that Spark and DuckDB share.

``{events}`` and the like are the provided tables. Every derivation groups the whole
table, and the grain it produces (one row per user and day, or per team and day) bounds
the length of each later series by the calendar.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from statmart.session import materialise
from statmart.sources.schemas import ENDPOINTS, raw_columns

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derive(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    """The same SQL over the oracle's views."""
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql


def tidy(df: DataFrame, digits: int = 7) -> DataFrame:
    """Round every double, so that last-bit differences between engines do not show."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def r(expr: str, out: str | None = None, digits: int = 7) -> str:
    """Oracle side of :func:`tidy`; adding 0.0 turns a negative zero into zero."""
    return f"(ROUND(CAST({expr} AS DOUBLE), {digits}) + 0.0) AS {out or expr.split('.')[-1]}"


# -- F1: entity x day box score -----------------------------------------------------

F1 = """
SELECT user_id AS person_id, CAST(ts AS DATE) AS game_date,
  user_id * 100 + CAST(day(ts) AS BIGINT) AS game_id,
  CASE WHEN day(ts) <= 15 THEN 22024 ELSE 22025 END AS season_id,
  'First' || CAST(user_id AS STRING) AS first_name, 'Family' || CAST(user_id % 7 AS STRING) AS family_name,
  CASE WHEN SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS played_flag,
  CASE WHEN SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) = 0 THEN ''
       ELSE CAST(COUNT(*) * 5 AS STRING) || ':' || lpad(CAST(user_id % 60 AS STRING), 2, '0') END AS clock,
  CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
  CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
  CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS signups,
  CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
  ROUND(SUM(value), 2) AS points,
  ROUND(AVG(CASE WHEN event_type = 'purchase' THEN value END), 4) AS avg_purchase
FROM {events} GROUP BY user_id, CAST(ts AS DATE), day(ts)
"""

# -- F2: team x day -----------------------------------------------------------------

F2 = """
WITH t AS (
  SELECT user_id % 10 AS team_id, CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * (day(ts) - day(ts) % 4) AS DATE) AS game_date, CAST(day(ts) AS BIGINT) AS dd,
    ROUND(SUM(value), 2) AS points, CAST(COUNT(*) AS BIGINT) AS attempts
  FROM {events} GROUP BY user_id % 10, CAST(ts AS DATE), day(ts)
), g AS (
  SELECT *, CASE WHEN dd % 2 = 0 THEN (team_id - team_id % 2) ELSE ((team_id + 1) % 10 - (team_id + 1) % 10 % 2) END AS pair
  FROM t
), s AS (SELECT *, dd * 10 + pair AS game_id FROM g)
SELECT a.game_id, a.game_date, a.team_id,
  CASE WHEN a.dd <= 15 THEN 22024 ELSE 22025 END AS season_id,
  'T' || CAST(a.team_id AS STRING) AS team_code, 'Team ' || CAST(a.team_id AS STRING) AS team_name,
  CASE WHEN (a.team_id + CASE WHEN a.dd % 4 < 2 THEN 0 ELSE 1 END) % 2 = 0 THEN 'T' || CAST(a.team_id AS STRING) || ' vs. T' || CAST(b.team_id AS STRING)
       ELSE 'T' || CAST(a.team_id AS STRING) || ' @ T' || CAST(b.team_id AS STRING) END AS matchup,
  CASE WHEN a.points > b.points THEN 'W' WHEN a.points < b.points THEN 'L' END AS win_loss,
  ROUND(a.points - b.points, 2) AS plus_minus, a.points, a.attempts
FROM s a JOIN s b ON a.game_id = b.game_id AND a.team_id <> b.team_id
"""

# -- F3: book lines, F4: roster snapshot, F5: names ----------------------------------

F3 = """
SELECT DISTINCT CAST(year(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * (day(ts) - day(ts) % 4) AS DATE)) * 10000 + month(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * (day(ts) - day(ts) % 4) AS DATE)) * 100 + day(CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * (day(ts) - day(ts) % 4) AS DATE)) AS BIGINT) AS date, 'TEAM-' || CAST(user_id % 10 AS STRING) AS team,
  CAST((user_id % 10 * 7 + day(ts)) % 21 - 10 AS DOUBLE) + 0.5 AS line,
  CAST(1000 + day(ts) * 10 AS DOUBLE) AS total
FROM {events}
"""

F4 = """
SELECT DISTINCT CAST('2024-01-30' AS DATE) AS snapshot_date, 'FT' || CAST(user_id % 8 AS STRING) AS fantasy_team,
  user_id AS player_id, 'First' || CAST(user_id AS STRING) || ' Family' || CAST(user_id % 7 AS STRING) AS name
FROM {events}
"""

F5 = """
SELECT p_partkey AS left_id, p_name AS right_name,
  CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) || ' Jr.'
       WHEN p_partkey % 4 = 1 THEN replace(p_name, 'e', 'é')
       WHEN p_partkey % 4 = 2 THEN substr(p_name, 1, length(p_name) - 1)
       ELSE 'zz ' || p_brand END AS left_name
FROM {part}
"""

# -- the raw domain tables, all text -------------------------------------------------

# Player-games (pg), team-games (tg) and half-team-games (hg): the layers the raw tables read.
LAYERS = {
    "pg": """
  SELECT *, '00' || kind || lpad(CAST(dd * 10 + pair AS STRING), 7, '0') AS gid,
    kind || CASE WHEN dd <= 15 THEN '2024' ELSE '2025' END AS sid
  FROM (
    SELECT *, CASE WHEN dd % 2 = 0 THEN (tno - tno % 2) ELSE ((tno + 1) % 10 - (tno + 1) % 10 % 2) END AS pair,
      CASE WHEN dd IN (14, 29) THEN '4' WHEN dd = 5 THEN '6' ELSE '2' END AS kind
    FROM (
      SELECT user_id AS pid, user_id % 10 AS tno, CAST(CAST(ts AS DATE) + INTERVAL '1' DAY * (day(ts) - day(ts) % 4) AS DATE) AS d, CAST(day(ts) AS BIGINT) AS dd,
        CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS v,
        CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS c,
        CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS p,
        CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS e,
        CAST(COUNT(*) AS BIGINT) AS n
      FROM {events} GROUP BY user_id, user_id % 10, CAST(ts AS DATE), day(ts)
    ) AS box
  ) AS paired""",
    "tg": """
  SELECT gid, sid, tno, d, dd, CAST(SUM(v) AS BIGINT) AS v, CAST(SUM(c) AS BIGINT) AS c,
    CAST(SUM(p) AS BIGINT) AS p, CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(n) AS BIGINT) AS n,
    tno * 37 AS pid
  FROM {pg} GROUP BY gid, sid, tno, d, dd""",
    "hg": """
  SELECT gid, tno, d, dd, CASE WHEN (pid - pid % 10) % 20 = 0 THEN 'Starters' ELSE 'Bench' END AS half,
    CAST(SUM(v) AS BIGINT) AS v, CAST(SUM(c) AS BIGINT) AS c, CAST(SUM(p) AS BIGINT) AS p,
    CAST(SUM(e) AS BIGINT) AS e, CAST(SUM(n) AS BIGINT) AS n, tno * 37 AS pid
  FROM {pg} GROUP BY gid, tno, d, dd, CASE WHEN (pid - pid % 10) % 20 = 0 THEN 'Starters' ELSE 'Bench' END""",
}

_TEAM_IDS = {
    "gameid": "gid",
    "teamid": "'100' || CAST(tno AS STRING)",
    "teamcity": "'City ' || CAST(tno AS STRING)",
    "teamname": "'Team ' || CAST(tno AS STRING)",
    "teamtricode": "'T' || CAST(tno AS STRING)",
    "teamslug": "'team' || CAST(tno AS STRING)",
}
_PERSON_IDS = {
    "personid": "CAST(pid AS STRING)",
    "firstname": "'First' || CAST(pid AS STRING)",
    "familyname": "'Family' || CAST(pid % 7 AS STRING)",
    "namei": "'F. Family' || CAST(pid % 7 AS STRING)",
    "playerslug": "'slug-' || CAST(pid AS STRING)",
    "position": "CASE WHEN pid % 3 = 0 THEN 'G' WHEN pid % 3 = 1 THEN 'F' ELSE '' END",
    "comment": "CASE WHEN n = e THEN 'DNP' ELSE '' END",
    "jerseynum": "CAST(pid % 99 AS STRING)",
}
_CLOCK = (
    "CASE WHEN n = e THEN '' WHEN (pid + dd) % 17 = 0 THEN NULL WHEN (pid + dd) % 31 = 0 THEN '34' "
    "ELSE CAST(5 + n * 4 AS STRING) || ':' || lpad(CAST(pid % 60 AS STRING), 2, '0') END"
)


def _measure(i: int) -> str:
    """Text of measure ``i``: now and then NULL or no number, else a whole number up to 28."""
    a, b, k, m = 3 + i % 5, 2 + i % 7, 1 + i % 4, 19 + i % 11
    return (
        f"CASE WHEN (pid + dd + {i}) % 43 = 0 THEN NULL WHEN (pid * 3 + dd + {i}) % 211 = 0 THEN 'n/a' "
        f"ELSE CAST((v * {a} + c * {b} + p * 3 + e + pid * {1 + i % 3} + dd * {k}) % {m} AS STRING) END"
    )


def _endpoint_sql(endpoint: str, is_team: bool) -> str:
    cols, offset = [], list(ENDPOINTS).index(endpoint) * 23
    # Gaps: advanced lacks some player-games and misc one team (no other table has their ids), which the joins must survive.
    gap = {
        ("advanced", False): "(pid + dd) % 13 = 3",
        ("misc", False): "pid % 5 = 2",
        ("misc", True): "tno = 3",
    }.get((endpoint, is_team))
    source = ("hg" if endpoint == "traditional" else "tg") if is_team else "pg"
    for i, c in enumerate(raw_columns(endpoint, is_team)):
        if c == "gameid" and gap:
            expr = f"CASE WHEN {gap} THEN 'x' || gid ELSE gid END"
        elif c in _TEAM_IDS:
            expr = _TEAM_IDS[c]
        elif c in _PERSON_IDS:
            expr = _PERSON_IDS[c]
        elif c == "minutes":
            expr = "'240:00'" if is_team else _CLOCK
        elif c == "startersbench":
            expr = "half"
        else:
            expr = _measure(offset + i)
        cols.append(f"{expr} AS {c}")
    return f"SELECT {', '.join(cols)} FROM {{{source}}}"


_LOG = {
    "fgm": "v", "fga": "v + c", "fg3m": "c", "fg3a": "c + p", "ftm": "p", "fta": "p + e", "oreb": "e",
    "dreb": "v + e", "reb": "v + 2 * e", "ast": "c + 1", "stl": "p + 1", "blk": "e + 1", "tov": "n % 9", "pf": "n % 7",
}
_SCORE = "(2 * {x}.v + 3 * {x}.c + {x}.p)"

_LOG_SQL = (
    "SELECT a.sid AS season_id, '100' || CAST(a.tno AS STRING) AS team_id, 'T' || CAST(a.tno AS STRING) AS team_abbreviation, "
    "'Team ' || CAST(a.tno AS STRING) AS team_name, a.gid AS game_id, CAST(a.d AS STRING) AS game_date, "
    "CASE WHEN (a.tno + CASE WHEN a.dd % 4 < 2 THEN 0 ELSE 1 END) % 2 = 0 "
    "THEN 'T' || CAST(a.tno AS STRING) || ' vs. T' || CAST(COALESCE(b.tno, 99) AS STRING) "
    "ELSE 'T' || CAST(a.tno AS STRING) || ' @ T' || CAST(COALESCE(b.tno, 99) AS STRING) END AS matchup, "
    f"CASE WHEN {_SCORE.format(x='a')} > {_SCORE.format(x='b')} THEN 'W' WHEN {_SCORE.format(x='a')} < {_SCORE.format(x='b')} THEN 'L' END AS wl, "
    "'240' AS min, "
    f"CASE WHEN (a.tno + a.dd) % 7 = 0 THEN NULL ELSE CAST({_SCORE.format(x='a')} AS STRING) END AS pts, "
    + ", ".join(
        f"CASE WHEN (a.tno + a.dd) % 11 = {i % 11} THEN NULL ELSE CAST("
        + re.sub(r"\b([vcpen])\b", r"a.\1", e)
        + f" AS STRING) END AS {c}"
        for i, (c, e) in enumerate(_LOG.items())
    )
    + ", " + ", ".join(
        f"CAST(ROUND(CAST(a.{x} AS DOUBLE) / (a.n + 1), 3) AS STRING) AS {c}"
        for c, x in {"fg_pct": "v", "fg3_pct": "c", "ft_pct": "p"}.items()
    )
    + f", CAST({_SCORE.format(x='a')} - {_SCORE.format(x='b')} AS STRING) AS plus_minus "
    "FROM {tg} a LEFT JOIN {tg} b ON a.gid = b.gid AND a.tno <> b.tno"
)

_LINES_SQL = (
    "SELECT DISTINCT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date, 'TEAM-' || CAST(tno AS STRING) AS team, 'any' AS site, "
    "'x' AS `o:team`, CAST((tno * 7 + dd) % 21 - 10 AS DOUBLE) + 0.5 AS line, CAST(60 + dd * 3 AS DOUBLE) AS total FROM {tg}"
)
_MAPPING_SQL = (
    "SELECT DISTINCT 'TEAM-' || CAST(tno AS STRING) AS raw_data_team_name, "
    "CASE WHEN tno = 7 THEN 'No Team' ELSE 'Team ' || CAST(tno AS STRING) END AS log_table_team_name FROM {tg}"
)

RAW = {
    "log_table": _LOG_SQL,
    "lines_table": _LINES_SQL,
    "line_team_mapping": _MAPPING_SQL,
    **{f"players_{e}": _endpoint_sql(e, False) for e in ENDPOINTS},
    **{f"teams_{e}": _endpoint_sql(e, True) for e in ENDPOINTS},
}


def layers(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The layers, with the two that several raw tables read written once.

    The events are scanned and shuffled a single time; every raw table is then a
    projection of a stored layer.
    """
    pg = materialise(derive(spark, sf, LAYERS["pg"]), "player-games")
    tg = materialise(spark.sql(LAYERS["tg"], pg=pg), "team-games")
    return {"pg": pg, "tg": tg, "hg": spark.sql(LAYERS["hg"], pg=pg)}


def raw_table(stored: dict[str, DataFrame], name: str) -> DataFrame:
    sql = RAW[name]
    used = {k: df for k, df in stored.items() if f"{{{k}}}" in sql}
    return next(iter(used.values())).sparkSession.sql(sql, **used)


def raw_ctes() -> str:
    """All raw tables as CTEs for the oracle, without the leading WITH."""
    sql = ", ".join(f"{n} AS ({text})" for n, text in {**LAYERS, **RAW}.items())
    for name in LAYERS:
        sql = sql.replace(f"{{{name}}}", name)
    return duck(sql).replace("`o:team`", '"o:team"')
