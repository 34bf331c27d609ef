"""Single operators over the provided tables and the F1-F5 views, each with its oracle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions import casts, dates, scoring, text
from statmart.operators import joins, nested, resolve, series, sets, stats, trades, upsert
from statmart.plans import rosters
from statmart.plans.combined import team_totals
from statmart.session import materialise

from . import models_sql as q
from .inputs import F1, F2, F3, F4, F5, derive, duck, r, table, tidy

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, digits: int = 7):
    """Register a query with its oracle SQL (``None``: rows only, tested in ``tests/``)."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf: tidy(fn(spark, sf), digits)
        if sql is not None:
            ORACLES[name] = duck(sql)
        return fn

    return wrap


def f1(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, F1)


MEASURES = ["views", "clicks", "signups", "purchases", "points", "avg_purchase"]
SERIES = ["person_id", "season_id"]
ORDER = ["game_date", "game_id"]
F1W = "OVER (PARTITION BY person_id, season_id ORDER BY game_date, game_id ROWS {})"
WITH1 = f"WITH f1 AS ({F1}) "
PLAYED = "CASE WHEN played_flag = 1 THEN {} END"


def _avgs(frame: str, cond: bool = False) -> str:
    return ", ".join(
        r(f"AVG({PLAYED.format(c) if cond else c}) {F1W.format(frame)}", f"avg_{c}") for c in MEASURES
    )


# -- expanding, rolling, ranking on F1 ------------------------------------------------

_CURRENT = f"""cur AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id, season_id
  ORDER BY played_flag DESC, game_date DESC, game_id DESC) AS rn FROM (
  SELECT *, {', '.join(f"AVG({PLAYED.format(c)}) {F1W.format('UNBOUNDED PRECEDING')} AS m_{c}" for c in MEASURES)} FROM f1))
  WHERE rn = 1 AND played_flag = 1)"""
_ZED = f"""z AS (SELECT season_id, person_id, first_name, family_name, game_date, {', '.join(
  f"(m_{c} - AVG(m_{c}) OVER (PARTITION BY season_id)) / NULLIF(STDDEV_SAMP(m_{c}) OVER (PARTITION BY season_id), 0) AS z_{c}"
  for c in MEASURES)} FROM cur)"""
_TOTAL = " + ".join(f"z_{c}" for c in MEASURES)


def current_means(df: DataFrame) -> DataFrame:
    played = F.col("played_flag") == 1
    df = series.expanding_avg(df, {f"m_{c}": c for c in MEASURES}, SERIES, ORDER, cond=played)
    df = series.last_active_flag(df, "is_last", played, SERIES, ORDER)
    return df.filter("is_last = 1")


@register(
    "season_z_ranking",
    f"""{WITH1}, {_CURRENT}, {_ZED} SELECT season_id, person_id, first_name, family_name, {r('total', 'total_z', 8)},
    RANK() OVER (PARTITION BY season_id ORDER BY total DESC) AS player_rank
    FROM (SELECT *, ROUND({_TOTAL}, 8) AS total FROM z) WHERE total IS NOT NULL""",
    digits=8,
)
def season_z_ranking(spark, sf):
    z = stats.zscores(materialise(current_means(f1(spark, sf)), "current-means"), {f"z_{c}": f"m_{c}" for c in MEASURES}, ["season_id"])
    total = z.withColumn("total_z", F.round(scoring.total_of([f"z_{c}" for c in MEASURES]), 8))
    ranked = stats.rank_desc(total.filter("total_z IS NOT NULL"), "total_z", ["season_id"], rank="player_rank")
    return ranked.select("season_id", "person_id", "first_name", "family_name", "total_z", "player_rank")


@register("expanding_avg", f"{WITH1} SELECT game_id, {_avgs('UNBOUNDED PRECEDING')} FROM f1")
def expanding_avg(spark, sf):
    out = series.expanding_avg(f1(spark, sf), {f"avg_{c}": c for c in MEASURES}, SERIES, ORDER)
    return out.select("game_id", *[f"avg_{c}" for c in MEASURES])


@register("expanding_avg_played", f"{WITH1} SELECT game_id, {_avgs('UNBOUNDED PRECEDING', True)} FROM f1")
def expanding_avg_played(spark, sf):
    out = series.expanding_avg(
        f1(spark, sf), {f"avg_{c}": c for c in MEASURES}, SERIES, ORDER, cond=F.col("played_flag") == 1
    )
    return out.select("game_id", *[f"avg_{c}" for c in MEASURES])


@register(
    "rolling10_full",
    f"""{WITH1} SELECT * FROM (SELECT game_id, {_avgs('9 PRECEDING')}, COUNT(*) {F1W.format('9 PRECEDING')} AS games_in_window
    FROM f1) WHERE games_in_window >= 10""",
)
def rolling10_full(spark, sf):
    out = series.rolling_avg(f1(spark, sf), {f"avg_{c}": c for c in MEASURES}, 10, SERIES, ORDER, "games_in_window")
    return series.require_full(out, "games_in_window", 10).select(
        "game_id", *[f"avg_{c}" for c in MEASURES], "games_in_window"
    )


@register(
    "rolling3_delta",
    f"""{WITH1} SELECT game_id, {', '.join(r(f'l_{c} - s_{c}', f'delta_{c}') for c in MEASURES)},
    {r('0.6 * (l_points - s_points) + 0.4 * (l_clicks - s_clicks)', 'pickup_score')} FROM (SELECT *,
    {', '.join(f'AVG({c}) OVER (PARTITION BY person_id ORDER BY game_date, game_id ROWS 2 PRECEDING) AS l_{c}' for c in MEASURES)},
    {', '.join(f"AVG({PLAYED.format(c)}) {F1W.format('UNBOUNDED PRECEDING')} AS s_{c}" for c in MEASURES)} FROM f1) WHERE played_flag = 1""",
)
def rolling3_delta(spark, sf):
    played = F.col("played_flag") == 1
    df = series.expanding_avg(f1(spark, sf), {f"s_{c}": c for c in MEASURES}, SERIES, ORDER, cond=played)
    df = series.rolling_avg(df, {f"l_{c}": c for c in MEASURES}, 3, ["person_id"], ORDER)
    df = df.withColumns({f"delta_{c}": F.col(f"l_{c}") - F.col(f"s_{c}") for c in MEASURES}).filter(played)
    return df.select(
        "game_id", *[f"delta_{c}" for c in MEASURES],
        scoring.weighted_score({"delta_points": 0.6, "delta_clicks": 0.4}).alias("pickup_score"),
    )


_TOTALS = f"""tot AS (SELECT season_id, person_id, MAX(first_name) AS first_name, MAX(family_name) AS family_name,
  COUNT(*) FILTER (WHERE played_flag = 1) AS games_played,
  {', '.join(f'CAST(SUM({PLAYED.format(c)}) AS DOUBLE) AS sum_{c}' for c in MEASURES[:5])},
  AVG({PLAYED.format('avg_purchase')}) AS mean_purchase FROM f1 GROUP BY season_id, person_id)"""
_SUMS = [*[f"sum_{c}" for c in MEASURES[:5]], "mean_purchase"]


def season_totals_frame(spark, sf):
    played = F.col("played_flag") == 1
    return f1(spark, sf).groupBy("season_id", "person_id").agg(
        F.max("first_name").alias("first_name"), F.max("family_name").alias("family_name"),
        F.count_if(played).alias("games_played"),
        *[scoring.sum_when(played, c).cast("double").alias(f"sum_{c}") for c in MEASURES[:5]],
        scoring.avg_when(played, "avg_purchase").alias("mean_purchase"),
    )


@register(
    "season_totals",
    f"{WITH1}, {_TOTALS} SELECT season_id, person_id, first_name, family_name, games_played, {', '.join(r(c) for c in _SUMS)} FROM tot",
)
def season_totals(spark, sf):
    return season_totals_frame(spark, sf)


_TZ = ", ".join(
    f"({c} - AVG({c}) OVER (PARTITION BY season_id)) / NULLIF(STDDEV_SAMP({c}) OVER (PARTITION BY season_id), 0) AS z_{c}"
    for c in _SUMS
)


@register(
    "totals_z",
    f"{WITH1}, {_TOTALS}, tz AS (SELECT season_id, person_id, {_TZ} FROM tot) SELECT season_id, person_id, "
    f"{', '.join(r(f'z_{c}') for c in _SUMS)}, {r(' + '.join(f'z_{c}' for c in _SUMS), 'total_z')} FROM tz",
)
def totals_z(spark, sf):
    z = stats.zscores(season_totals_frame(spark, sf), {f"z_{c}": c for c in _SUMS}, ["season_id"])
    total = scoring.total_of([f"z_{c}" for c in _SUMS]).alias("total_z")
    return z.select("season_id", "person_id", *[f"z_{c}" for c in _SUMS], total)


_WEEK = f"""wk AS (SELECT *, DENSE_RANK() OVER (PARTITION BY season_id ORDER BY week_start) AS week_number FROM (
  SELECT person_id, season_id, CAST(date_trunc('week', game_date) AS DATE) AS week_start,
  COUNT(*) FILTER (WHERE played_flag = 1) AS games_played,
  {', '.join(f'CAST(SUM({PLAYED.format(c)}) AS DOUBLE) AS sum_{c}' for c in MEASURES[:5])} FROM f1 GROUP BY ALL))"""


@register(
    "weekly_stats",
    f"""{WITH1}, {_WEEK} SELECT person_id, season_id, week_start, CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end,
    season_id || '_' || strftime(week_start, '%G-%V') AS week_id, week_number, games_played, {', '.join(r(f'sum_{c}') for c in MEASURES[:5])},
    {r('(sum_points - AVG(sum_points) OVER w) / NULLIF(STDDEV_SAMP(sum_points) OVER w, 0)', 'z_points')}
    FROM wk WINDOW w AS (PARTITION BY season_id, week_start)""",
)
def weekly_stats(spark, sf):
    played = F.col("played_flag") == 1
    wk = f1(spark, sf).withColumn("week_start", dates.week_start("game_date")).groupBy(
        "person_id", "season_id", "week_start"
    ).agg(
        F.count_if(played).alias("games_played"),
        *[scoring.sum_when(played, c).cast("double").alias(f"sum_{c}") for c in MEASURES[:5]],
    )
    wk = stats.dense_index(wk, "week_number", "week_start", ["season_id"])
    z = stats.zscores(wk, {"z_points": "sum_points"}, ["season_id", "week_start"])
    return z.withColumns(
        {
            "week_end": dates.week_end("week_start"),
            "week_id": text.concat_text("season_id", F.lit("_"), dates.iso_year_week("week_start")),
        }
    )


@register(
    "season_final",
    f"""{WITH1}, {_CURRENT}, {_TOTALS}, few AS (SELECT * FROM cur WHERE m_points > 20)
    SELECT COALESCE(a.season_id, t.season_id) AS season_id, COALESCE(a.person_id, t.person_id) AS person_id,
    {r('a.m_points', 'm_points')}, t.games_played AS games_played, {r('t.sum_points', 'sum_points')}
    FROM few a FULL JOIN (SELECT * FROM tot WHERE sum_points > 100) t ON a.season_id = t.season_id AND a.person_id = t.person_id""",
)
def season_final(spark, sf):
    few = current_means(f1(spark, sf)).filter("m_points > 20").select("season_id", "person_id", "m_points")
    big = season_totals_frame(spark, sf).filter("sum_points > 100")
    return joins.full_outer_merge(
        [few, big.select("season_id", "person_id", "games_played", "sum_points")], ["season_id", "person_id"]
    )


@register(
    "overall_current",
    f"""{WITH1}, {_TOTALS}, lat AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY season_id, person_id
    ORDER BY avg_purchase DESC NULLS LAST, game_date DESC, game_id) AS rn FROM f1) WHERE rn = 1)
    SELECT t.season_id, CAST(t.person_id AS VARCHAR) AS person_id, t.games_played, l.game_id, l.game_date, {r('l.avg_purchase', 'avg_purchase')}
    FROM tot t LEFT JOIN lat l ON t.season_id = l.season_id AND t.person_id = l.person_id""",
)
def overall_current(spark, sf):
    last = series.latest_per(f1(spark, sf), ["season_id", "person_id"], ["avg_purchase", "game_date"], ["game_id"])
    last = last.select("season_id", "person_id", "game_id", "game_date", "avg_purchase")
    out = joins.attach(season_totals_frame(spark, sf), last, ["season_id", "person_id"])
    return out.select(
        "season_id", F.col("person_id").cast("string").alias("person_id"), "games_played", "game_id", "game_date",
        "avg_purchase",
    )


@register(
    "double_double",
    f"""{WITH1} SELECT game_id, CASE WHEN (CASE WHEN points >= 30 THEN 1 ELSE 0 END + CASE WHEN views >= 2 THEN 1 ELSE 0 END
      + CASE WHEN clicks >= 2 THEN 1 ELSE 0 END + CASE WHEN signups >= 2 THEN 1 ELSE 0 END + CASE WHEN purchases >= 2 THEN 1 ELSE 0 END) >= 2
      AND (points >= 30 OR views >= 2 OR clicks >= 2) THEN 1 ELSE 0 END AS double_double,
      {r('CASE WHEN purchases = 0 THEN NULL ELSE avg_purchase END', 'ratio')} FROM f1""",
)
def double_double(spark, sf):
    df = f1(spark, sf).withColumn("p", F.col("points") / 15)
    return df.select(
        "game_id",
        scoring.double_double("p", "views", "clicks", "signups", "purchases", threshold=2).alias("double_double"),
        casts.null_if_zero_den("avg_purchase", "purchases").alias("ratio"),
    )


@register(
    "ratio_guard",
    f"{WITH1} SELECT game_id, {r('CASE WHEN purchases = 0 THEN NULL ELSE points END', 'guarded')}, "
    f"{r('points / NULLIF(purchases, 0)', 'per_purchase')}, {r('COALESCE(avg_purchase, 0)', 'zeroed')} FROM f1",
)
def ratio_guard(spark, sf):
    return f1(spark, sf).select(
        "game_id",
        casts.null_if_zero_den("points", "purchases").alias("guarded"),
        (F.col("points") / casts.null_if_zero(F.col("purchases").cast("double"))).alias("per_purchase"),
        casts.zero_if_null("avg_purchase").alias("zeroed"),
    )


@register(
    "clock_minutes",
    f"""{WITH1} SELECT game_id, {r("COALESCE(TRY_CAST(split_part(c, ':', 1) AS DOUBLE) + TRY_CAST(split_part(c, ':', 2) AS DOUBLE) / 60, 0)", 'minutes')},
    CASE WHEN TRY_CAST(split_part(c, ':', 1) AS DOUBLE) > 0 OR TRY_CAST(split_part(c, ':', 2) AS DOUBLE) > 0 THEN 1 ELSE 0 END AS played
    FROM (SELECT *, CASE WHEN clock = '' THEN '00:00' WHEN game_id % 7 = 0 THEN '34' ELSE clock END AS c FROM f1)""",
)
def clock_minutes(spark, sf):
    clock = F.when((F.col("clock") != "") & (F.col("game_id") % 7 == 0), "34").otherwise(F.col("clock"))
    df = f1(spark, sf).withColumn("c", clock)
    return df.select("game_id", text.clock_minutes("c").alias("minutes"), text.played_flag("c").alias("played"))


# -- teams: F2 and F3 -----------------------------------------------------------------

WITH2 = f"WITH f2 AS ({F2}) "
TW = "OVER (PARTITION BY team_id, season_id ORDER BY game_date, game_id{})"
TEAM = ["team_id", "season_id"]


@register(
    "team_schedule",
    f"""{WITH2} SELECT game_id, team_id, ROW_NUMBER() {TW.format('')} AS game_number,
    date_diff('day', LAG(game_date) {TW.format('')}, game_date) AS rest_days,
    CASE WHEN date_diff('day', LAG(game_date) {TW.format('')}, game_date) = 1 THEN 1 ELSE 0 END AS back_to_back,
    (SELECT COUNT(*) FROM f2 o WHERE o.team_id = t.team_id AND o.season_id = t.season_id AND o.game_date BETWEEN t.game_date - INTERVAL 3 DAY AND t.game_date) AS games4,
    (SELECT COUNT(*) FROM f2 o WHERE o.team_id = t.team_id AND o.season_id = t.season_id AND o.game_date BETWEEN t.game_date - INTERVAL 5 DAY AND t.game_date) AS games6,
    LEAD(game_id) {TW.format('')} AS next_game_id,
    CASE WHEN game_date = MAX(game_date) OVER (PARTITION BY team_id, season_id) THEN 1 ELSE 0 END AS is_last FROM f2 t""",
)
def team_schedule(spark, sf):
    df = derive(spark, sf, F2)
    df = series.sequence_number(df, "game_number", TEAM, ORDER)
    df = series.days_since_prev(df, "rest_days", "game_date", TEAM, ORDER)
    df = series.next_id(df, "next_game_id", "game_id", TEAM, ORDER)
    df = series.count_in_trailing_days(df, {"games4": 3, "games6": 5}, TEAM, "game_date")
    df = series.is_last(df, "is_last", "game_date", TEAM)
    return df.select(
        "game_id", "team_id", "game_number", "rest_days", series.is_back_to_back("rest_days").alias("back_to_back"),
        "games4", "games6", "next_game_id", "is_last",
    )


@register(
    "team_record",
    f"""{WITH2} SELECT game_id, team_id, CAST(SUM(CASE WHEN win_loss = 'W' THEN 1 ELSE 0 END) {TW.format(' ROWS UNBOUNDED PRECEDING')} AS BIGINT) AS wins,
    CAST(SUM(CASE WHEN win_loss = 'L' THEN 1 ELSE 0 END) {TW.format(' ROWS UNBOUNDED PRECEDING')} AS BIGINT) AS losses,
    {r(f"ROUND(CAST(SUM(CASE WHEN win_loss = 'W' THEN 1 ELSE 0 END) {TW.format(' ROWS 9 PRECEDING')} AS DOUBLE) / LEAST(10, ROW_NUMBER() {TW.format('')}), 3)", 'rate10')} FROM f2""",
)
def team_record(spark, sf):
    won, lost = F.col("win_loss") == "W", F.col("win_loss") == "L"
    df = series.running_count(derive(spark, sf, F2), {"wins": won, "losses": lost}, TEAM, ORDER)
    return series.rolling_rate(df, "rate10", won, 10, TEAM, ORDER).select("game_id", "team_id", "wins", "losses", "rate10")


@register(
    "vs_opponent",
    f"""{WITH2}, o AS (SELECT *, {q.SIDES.format(m='matchup')}[2] AS opponent FROM f2)
    SELECT game_id, team_id, opponent, contains(matchup, ' vs. ') AS home,
    {q.side_sql('matchup', "contains(matchup, ' vs. ')", True)} AS home_team, {q.side_sql('matchup', "contains(matchup, ' vs. ')", False)} AS away_team,
    CAST(SUM(CASE WHEN win_loss = 'W' THEN 1 ELSE 0 END) OVER (PARTITION BY team_id, opponent, season_id ORDER BY game_date, game_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS wins_before FROM o""",
)
def vs_opponent(spark, sf):
    df = derive(spark, sf, F2).withColumn("opponent", text.opponent_code("matchup"))
    df = series.running_count(
        df, {"wins_before": F.col("win_loss") == "W"}, ["team_id", "opponent", "season_id"], ORDER, prior_only=True
    )
    return df.select(
        "game_id", "team_id", "opponent", text.is_home("matchup").alias("home"),
        text.home_team("matchup").alias("home_team"), text.away_team("matchup").alias("away_team"), "wins_before",
    )


_MAP = "map AS (SELECT DISTINCT 'TEAM-' || CAST(user_id % 10 AS STRING) AS book, 'Team ' || CAST(user_id % 10 AS STRING) AS log_name FROM {events} WHERE user_id % 10 <> 7)"
_LINED = f"""f3 AS ({F3}), {_MAP}, lined AS (SELECT f2.*, f3.line, f3.total FROM f3 JOIN map ON f3.team = map.book
  JOIN f2 ON f2.team_name = map.log_name AND f2.game_date = CAST(strptime(CAST(f3.date AS VARCHAR), '%Y%m%d') AS DATE))"""


def lined(spark, sf):
    mapping = derive(spark, sf, f"WITH {_MAP} SELECT * FROM map")
    lines = derive(spark, sf, F3).withColumn("p_date", dates.date_from_int("date"))
    named = joins.map_names(lines, mapping, "team", "book", "log_name", "log_name")
    games = derive(spark, sf, F2)
    cond = (games["game_date"] == named["p_date"]) & (games["team_name"] == named["log_name"])
    return games.join(named.select("p_date", "log_name", "line", "total"), cond)


@register("lines_join", f"{WITH2}, {_LINED} SELECT game_id, team_code, game_date, {r('line')}, {r('total')} FROM lined")
def lines_join(spark, sf):
    return lined(spark, sf).select("game_id", "team_code", "game_date", "line", "total")


@register(
    "opponent_outcomes",
    f"""{WITH2}, {_LINED}, o AS (SELECT a.*, b.points AS opp_points, contains(a.matchup, ' vs. ') AS home FROM lined a JOIN f2 b
      ON a.game_id = b.game_id AND a.team_id <> b.team_id)
    SELECT game_id, team_id, {r('opp_points')}, {q.cover_sql('plus_minus', 'home', 'line')} AS cover,
    {q.over_under_sql('points + opp_points', 'total')} AS over_under, {q.SEASON_KIND.format(s='season_id')} AS kind FROM o""",
)
def opponent_outcomes(spark, sf):
    other = derive(spark, sf, F2).select("game_id", F.col("team_id").alias("o_team"), F.col("points").alias("opp_points"))
    df = lined(spark, sf).join(other, "game_id").filter("team_id <> o_team")
    return df.select(
        "game_id", "team_id", "opp_points",
        scoring.cover_result("line", text.is_home("matchup"), "plus_minus").alias("cover"),
        scoring.over_under_result("points", "opp_points", "total").alias("over_under"),
        text.season_type("season_id").alias("kind"),
    )


@register(
    "opponent_self_join",
    f"{WITH2} SELECT a.game_id, a.team_id, {r('a.points', 'points')}, {r('b.points', 'opp_points')}, b.attempts AS opp_attempts "
    "FROM f2 a JOIN f2 b ON a.game_id = b.game_id AND a.team_id <> b.team_id",
)
def opponent_self_join(spark, sf):
    df = joins.with_opponent(derive(spark, sf, F2), "game_id", "team_id", {"points": "opp_points", "attempts": "opp_attempts"})
    return df.select("game_id", "team_id", "points", "opp_points", "opp_attempts")


# -- joins and typing on orders and lineitem ------------------------------------------

_LI = """li AS (SELECT CAST(l_orderkey AS STRING) AS okey, CAST(COUNT(*) AS STRING) AS n_lines,
  CAST(CAST(SUM(l_quantity) AS BIGINT) AS STRING) AS qty, CASE WHEN l_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(MAX(l_linenumber) AS STRING) END AS top_line
  FROM {lineitem} GROUP BY l_orderkey)"""
_LOGO = """log AS (SELECT lpad(CAST(o_orderkey AS STRING), 10, '0') AS okey, CAST(o_custkey AS STRING) AS ckey,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS odate, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS STRING) END AS qty FROM {orders})"""
_CUS = "cus AS (SELECT CAST(c_custkey AS STRING) AS ckey, c_mktsegment AS segment, CAST(c_nationkey AS STRING) AS nation FROM {customer})"


@register(
    "star_join_typed",
    f"""WITH {_LI}, {_LOGO}, {_CUS} SELECT TRY_CAST(log.okey AS BIGINT) AS order_id, TRY_CAST(odate AS DATE) AS order_date,
    {r('COALESCE(TRY_CAST(log.qty AS DOUBLE), TRY_CAST(li.qty AS DOUBLE))', 'qty')}, {r('TRY_CAST(li.top_line AS DOUBLE)', 'top_line')},
    TRY_CAST(li.n_lines AS BIGINT) AS n_lines, cus.segment AS segment FROM log
    LEFT JOIN li ON TRY_CAST(log.okey AS BIGINT) = TRY_CAST(li.okey AS BIGINT)
    LEFT JOIN cus ON TRY_CAST(log.ckey AS BIGINT) = TRY_CAST(cus.ckey AS BIGINT)""",
)
def star_join_typed(spark, sf):
    log = derive(spark, sf, f"WITH {_LOGO} SELECT * FROM log")
    li = derive(spark, sf, f"WITH {_LI} SELECT * FROM li")
    cus = derive(spark, sf, f"WITH {_CUS} SELECT * FROM cus")
    wide = joins.combine_star(log, {"li": li}, {"k": casts.try_long("okey")}, {"li": {"k": casts.try_long("li_okey")}})
    wide = joins.combine_star(wide, {"cus": cus}, {"k": casts.try_long("ckey")}, {"cus": {"k": casts.try_long("cus_ckey")}})
    return wide.select(
        casts.try_long("okey").alias("order_id"), casts.try_date("odate").alias("order_date"),
        casts.first_of(casts.try_double("qty"), casts.try_double("li_qty")).alias("qty"),
        casts.try_double("li_top_line").alias("top_line"), casts.try_long("li_n_lines").alias("n_lines"),
        F.col("cus_segment").alias("segment"),
    )


_CH = {
    "a": "SELECT CAST(o_orderkey AS STRING) AS k, CASE WHEN o_orderkey % 4 = 1 THEN 'x' ELSE '' END || CAST(o_custkey AS STRING) AS ck, CAST(o_orderkey % 10 AS STRING) AS x FROM {orders}",
    "b": "SELECT CASE WHEN l_orderkey % 3 = 2 THEN 'x' ELSE '' END || CAST(l_orderkey AS STRING) AS k, CAST(COUNT(*) AS STRING) AS x FROM {lineitem} GROUP BY l_orderkey",
    "c": "SELECT CAST(l_orderkey AS STRING) AS k, CAST(MAX(CASE WHEN l_linenumber BETWEEN 2 AND 5 THEN l_linenumber END) AS STRING) AS x FROM {lineitem} GROUP BY l_orderkey",
}


@register(
    "chain_join_typed",
    f"""WITH log AS (SELECT CAST(c_custkey AS STRING) AS ck, c_name FROM {{customer}}), {', '.join(f'{n} AS ({q})' for n, q in _CH.items())}
    SELECT DISTINCT TRY_CAST(log.ck AS BIGINT) AS cust_id, c_name, {r('TRY_CAST(a.x AS DOUBLE)', 'a_x')}, {r('TRY_CAST(b.x AS DOUBLE)', 'b_x')},
    {r('TRY_CAST(c.x AS DOUBLE)', 'c_x')} FROM log LEFT JOIN a ON TRY_CAST(log.ck AS BIGINT) = TRY_CAST(a.ck AS BIGINT)
    LEFT JOIN b ON TRY_CAST(a.k AS BIGINT) = TRY_CAST(b.k AS BIGINT) LEFT JOIN c ON TRY_CAST(b.k AS BIGINT) = TRY_CAST(c.k AS BIGINT)""",
)
def chain_join_typed(spark, sf):
    log = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("ck"), "c_name")
    chain = [(n, derive(spark, sf, q)) for n, q in _CH.items()]
    wide = joins.combine_chain(
        log, chain, ({"c": casts.try_long("ck")}, {"c": casts.try_long("a_ck")}), {"k": "k"}
    )
    return wide.select(
        casts.try_long("ck").alias("cust_id"), "c_name", *[casts.try_double(f"{n}_x").alias(f"{n}_x") for n in "abc"]
    ).distinct()


_HALF = """half AS (SELECT CAST(l_orderkey AS STRING) AS gameid, CAST(l_orderkey % 7 AS STRING) AS teamid, 'c' AS teamcity, 'n' AS teamname,
  't' AS teamtricode, 's' AS teamslug, l_linestatus AS startersbench, CAST(MAX(l_linenumber) AS STRING) AS minutes,
  CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE CAST(CAST(SUM(l_quantity) AS BIGINT) AS STRING) END AS points,
  CASE WHEN l_orderkey % 8 = 0 THEN 'x' ELSE CAST(COUNT(*) AS STRING) END AS steals,
  CAST(CAST(MAX(l_discount * 100) AS BIGINT) AS STRING) AS fieldgoalspercentage FROM {lineitem} GROUP BY l_orderkey, l_linestatus)"""


@register(
    "half_totals",
    f"""WITH {_HALF} SELECT gameid, teamid, MAX(minutes) AS minutes, {r('SUM(COALESCE(TRY_CAST(points AS DOUBLE), 0))', 'points')},
    {r('SUM(COALESCE(TRY_CAST(steals AS DOUBLE), 0))', 'steals')}, {r('AVG(TRY_CAST(fieldgoalspercentage AS DOUBLE))', 'fieldgoalspercentage')}
    FROM half GROUP BY gameid, teamid""",
)
def half_totals(spark, sf):
    halves = derive(spark, sf, f"WITH {_HALF} SELECT * FROM half")
    return team_totals(halves).select("gameid", "teamid", "minutes", "points", "steals", "fieldgoalspercentage")


@register(
    "current_season_filter",
    """WITH o AS (SELECT *, '2' || CAST(year(o_orderdate) AS STRING) AS season_id FROM {orders})
    SELECT o_orderkey, o_custkey, season_id FROM o WHERE season_id LIKE '2%'
    AND season_id = (SELECT CAST(MAX(CAST(season_id AS INTEGER)) AS VARCHAR) FROM o WHERE season_id LIKE '2%')""",
)
def current_season_filter(spark, sf):
    o = table(spark, sf, "orders").withColumn("season_id", F.concat(F.lit("2"), F.year("o_orderdate").cast("string")))
    newest = stats.scalar_max(o.filter(F.col("season_id").like("2%")), F.col("season_id").cast("int"), "s")
    season = newest.select(F.col("s").cast("string"))
    return joins.current_season_only(o, season, "season_id").select("o_orderkey", "o_custkey", "season_id")


@register(
    "rows_for_keys",
    """SELECT o_orderkey, o_custkey FROM {orders} JOIN (SELECT c_custkey AS k FROM {customer} WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey FROM {customer} WHERE c_acctbal > 5000) ON o_custkey = k""",
)
def rows_for_keys(spark, sf):
    c = table(spark, sf, "customer")
    keys = c.filter("c_mktsegment = 'BUILDING'").select("c_custkey").unionAll(c.filter("c_acctbal > 5000").select("c_custkey"))
    return joins.rows_for_keys(table(spark, sf, "orders"), "o_custkey", keys).select("o_orderkey", "o_custkey")


@register(
    "filter_to_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem} WHERE CAST(l_partkey AS VARCHAR) IN
    (SELECT CAST(p_partkey AS VARCHAR) FROM {part} WHERE p_size > 25)""",
)
def filter_to_keys(spark, sf):
    ids = table(spark, sf, "part").filter("p_size > 25").select("p_partkey")
    return joins.filter_to_keys(table(spark, sf, "lineitem"), "l_partkey", ids).select("l_orderkey", "l_linenumber", "l_partkey")


@register(
    "eq_intish_threshold",
    f"""SELECT o_orderkey, {r('o_totalprice')} FROM {{orders}} WHERE CAST(o_custkey % 10 AS VARCHAR) = '7'
    AND COALESCE(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END, -999) >= 1000""",
)
def eq_intish_threshold(spark, sf):
    o = table(spark, sf, "orders").withColumn("m", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_totalprice")))
    keep = casts.eq_intish(F.col("o_custkey") % 10, 7) & casts.at_least("m", 1000)
    return o.filter(keep).select("o_orderkey", "o_totalprice")


# -- aggregation, ranking and leaders on whole tables ---------------------------------

@register(
    "global_rank",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('l_extendedprice')}, RANK() OVER (ORDER BY l_extendedprice DESC) AS price_rank,
    DENSE_RANK() OVER (ORDER BY l_extendedprice DESC) AS price_dense FROM {{lineitem}}""",
)
def global_rank(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return stats.rank_desc(li, "l_extendedprice", rank="price_rank", dense="price_dense")


@register(
    "group_rank_ties",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, {r('l_quantity')}, RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS q_rank,
    DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS q_dense FROM {{lineitem}}""",
)
def group_rank_ties(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return stats.rank_desc(li, "l_quantity", ["l_returnflag"], rank="q_rank", dense="q_dense")


@register(
    "zscore_hot_groups",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, {r('(l_extendedprice - AVG(l_extendedprice) OVER w) / NULLIF(STDDEV_SAMP(l_extendedprice) OVER w, 0)', 'z_price', 5)},
    {r('(l_quantity - AVG(l_quantity) OVER w) / NULLIF(STDDEV_SAMP(l_quantity) OVER w, 0)', 'z_qty', 5)} FROM {{lineitem}} WINDOW w AS (PARTITION BY l_returnflag)""",
)
def zscore_hot_groups(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity")
    z = stats.zscores(li, {"z_price": "l_extendedprice", "z_qty": "l_quantity"}, ["l_returnflag"])
    return tidy(z.drop("l_extendedprice", "l_quantity"), 5)


@register(
    "top_n_orders",
    f"SELECT o_orderkey, {r('o_totalprice')}, RANK() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM {{orders}} ORDER BY orders.o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_n_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return stats.rank_top(o, "o_totalprice", 100, "price_rank", ["o_orderkey"])


@register(
    "category_leaders",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT season_id, '{c}' AS category, first_name || ' ' || family_name AS player, game_id FROM ({F1}) WHERE {c} IS NOT NULL "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY season_id ORDER BY {c} DESC, game_id) = 1)" for c in MEASURES
    ),
)
def category_leaders(spark, sf):
    best = stats.leaders(
        f1(spark, sf), {c: c for c in MEASURES}, ["season_id"], ["game_id"], ["first_name", "family_name", "game_id", "person_id"]
    )
    return best.select("season_id", "category", text.display_name("first_name", "family_name", "person_id").alias("player"), "game_id")


@register(
    "latest_per_customer",
    f"""SELECT o_custkey, o_orderkey, {r('o_totalprice')} FROM {{orders}}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",
)
def latest_per_customer(spark, sf):
    last = series.latest_per(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return last.select("o_custkey", "o_orderkey", "o_totalprice")


# -- long series: blocked windows over raw events --------------------------------------

EV = ["user_id"]
EV_ORDER = ["ts", "event_id"]
EVW = "OVER (PARTITION BY user_id ORDER BY ts, event_id{})"


def _day(df: DataFrame):
    return series.time_block("ts", "day")


@register(
    "series_expanding_blocked",
    f"""SELECT event_id, {r(f"AVG(value) {EVW.format(' ROWS UNBOUNDED PRECEDING')}", 'mean_all', 8)},
    {r(f"AVG(CASE WHEN event_type = 'purchase' THEN value END) {EVW.format(' ROWS UNBOUNDED PRECEDING')}", 'mean_purchase', 8)} FROM {{events}}""",
    digits=8,
)
def series_expanding_blocked(spark, sf):
    ev = table(spark, sf, "events")
    cols = {"mean_all": "value", "mean_purchase": F.when(F.col("event_type") == "purchase", F.col("value"))}
    return series.expanding_avg(ev, cols, EV, EV_ORDER, block=_day(ev)).select("event_id", *cols)


@register(
    "series_rolling_blocked",
    f"""SELECT event_id, {r(f"AVG(value) {EVW.format(' ROWS 9 PRECEDING')}", 'mean10')}, COUNT(*) {EVW.format(' ROWS 9 PRECEDING')} AS n10,
    {r(f"ROUND(CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) {EVW.format(' ROWS 9 PRECEDING')} AS DOUBLE) / LEAST(10, ROW_NUMBER() {EVW.format('')}), 3)", 'click_rate')}
    FROM {{events}}""",
)
def series_rolling_blocked(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type")
    means = series.mean_of_last({"mean10": "value"}, 10, "n10")
    clicks = series.rate_of_last("click_rate", F.col("event_type") == "click", 10)
    df = series.over_rows(ev, [means, clicks], EV, EV_ORDER, back=9, block=_day(ev))
    return df.select("event_id", "mean10", "n10", "click_rate")


@register(
    "series_sequence_blocked",
    f"""SELECT event_id, ROW_NUMBER() {EVW.format('')} AS seq,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) {EVW.format(' ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING')} AS BIGINT) AS bought_before,
    CASE WHEN event_type <> 'error' AND ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END DESC, ts DESC, event_id DESC) = 1
      THEN 1 ELSE 0 END AS is_last FROM {{events}}""",
)
def series_sequence_blocked(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    df = series.sequence_number(ev, "seq", EV, EV_ORDER, block=_day(ev))
    df = series.running_count(df, {"bought_before": F.col("event_type") == "purchase"}, EV, EV_ORDER, _day(ev), prior_only=True)
    df = series.last_active_flag(df, "is_last", F.col("event_type") != "error", EV, EV_ORDER, whole=False)
    return df.select("event_id", "seq", "bought_before", "is_last")


@register(
    "series_neighbours_blocked",
    f"""SELECT event_id, LEAD(event_id) {EVW.format('')} AS next_id, LAG(event_type) {EVW.format('')} AS prev_type,
    date_diff('day', CAST(LAG(ts) {EVW.format('')} AS DATE), CAST(ts AS DATE)) AS gap_days FROM {{events}}""",
)
def series_neighbours_blocked(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    near = [series.lead_of("next_id", "event_id"), series.lag_of("prev_type", "event_type"), series.gap_days("gap_days", "ts")]
    df = series.over_rows(ev, near, EV, EV_ORDER, back=1, ahead=1, block=_day(ev))
    return df.select("event_id", "next_id", "prev_type", "gap_days")


@register(
    "trailing_days_events",
    """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM {events}), n AS (SELECT user_id, d, COUNT(*) AS k FROM e GROUP BY user_id, d)
    SELECT e.event_id, CAST((SELECT SUM(k) FROM n WHERE n.user_id = e.user_id AND n.d BETWEEN e.d - INTERVAL 3 DAY AND e.d) AS BIGINT) AS last4 FROM e""",
)
def trailing_days_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("d"))
    return series.count_in_trailing_days(ev, {"last4": 3}, EV, "d", pre_aggregate=True).select("event_id", "last4")


# -- upserts ---------------------------------------------------------------------------

_TGT = "tgt AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 't' ELSE '' END || CAST(c_custkey AS STRING) AS id, c_name AS name, c_mktsegment AS segment FROM {customer})"
_BAT = """bat AS (SELECT CASE WHEN c_custkey % 10 = 4 THEN NULL WHEN c_custkey % 2 = 1 THEN 'b' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END AS id,
  upper(c_name) AS name, CAST(c_nationkey AS STRING) AS nation FROM {customer})"""


def _cte(spark, sf, cte: str) -> DataFrame:
    return derive(spark, sf, f"WITH {cte} SELECT * FROM {cte.split(' ', 1)[0]}")


@register(
    "upsert_delete_insert",
    f"""WITH {_TGT}, {_BAT} SELECT id, name, segment, CAST(NULL AS VARCHAR) AS nation FROM tgt WHERE NOT EXISTS (SELECT 1 FROM bat WHERE bat.id = tgt.id)
    UNION ALL SELECT id, name, NULL, nation FROM bat""",
)
def upsert_delete_insert(spark, sf):
    return upsert.upsert_delete_insert(_cte(spark, sf, _TGT), _cte(spark, sf, _BAT), ["id"])


_BAT2 = "bat AS (SELECT CASE WHEN c_custkey % 2 = 1 THEN 'b' ELSE '' END || CAST(c_custkey AS STRING) AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE upper(c_name) END AS name, CAST(c_nationkey AS STRING) AS nation FROM {customer})"


@register(
    "upsert_merge_coalesce",
    f"""WITH {_TGT}, {_BAT2} SELECT COALESCE(t.id, b.id) AS id, COALESCE(b.name, t.name) AS name, t.segment AS segment, b.nation AS nation
    FROM tgt t FULL JOIN bat b ON t.id = b.id""",
)
def upsert_merge_coalesce(spark, sf):
    return upsert.upsert_merge_coalesce(_cte(spark, sf, _TGT), _cte(spark, sf, _BAT2), ["id"])


@register(
    "append_new",
    f"WITH {_TGT}, {_BAT2} SELECT id, name, segment, CAST(NULL AS VARCHAR) AS nation FROM tgt UNION ALL SELECT id, name, NULL, nation FROM bat WHERE id NOT IN (SELECT id FROM tgt)",
)
def append_new(spark, sf):
    return upsert.append_new(_cte(spark, sf, _TGT), _cte(spark, sf, _BAT2), "id")


_BAT3 = "bat AS (SELECT CAST(c_custkey AS STRING) AS id, upper(c_name) AS name, c_mktsegment AS segment FROM {customer} WHERE c_mktsegment = 'BUILDING')"


@register(
    "replace_key",
    f"WITH {_TGT}, {_BAT3} SELECT * FROM tgt WHERE segment <> 'BUILDING' UNION ALL SELECT * FROM bat",
)
def replace_key(spark, sf):
    return upsert.replace_key(_cte(spark, sf, _TGT), _cte(spark, sf, _BAT3), "segment", "BUILDING")


_OTHER = "CASE WHEN player_id % {} = 0 THEN player_id ELSE player_id + {} END AS player_id"
_SNAP_T = f"""old AS (SELECT snapshot_date, fantasy_team, CASE WHEN player_id % 5 = 0 THEN player_id + 1000000 ELSE player_id END AS player_id, name FROM ({F4})
  UNION ALL SELECT CAST('2024-01-29' AS DATE), fantasy_team, player_id, name FROM ({F4}))"""
_SNAP_B = f"""new AS (SELECT snapshot_date, fantasy_team, {_OTHER.format(2, 2000000)}, upper(name) AS name FROM ({F4})
  UNION ALL SELECT snapshot_date, fantasy_team, {_OTHER.format(4, 3000000)}, name FROM ({F4}))"""
_SNAP_KEYS = ["snapshot_date", "fantasy_team", "player_id"]


@register(
    "snapshot_upsert",
    f"""WITH {_SNAP_T}, {_SNAP_B}, one AS (SELECT * FROM new QUALIFY ROW_NUMBER() OVER (PARTITION BY snapshot_date, fantasy_team, player_id ORDER BY name DESC) = 1)
    SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM one n WHERE n.snapshot_date = o.snapshot_date AND n.fantasy_team = o.fantasy_team AND n.player_id = o.player_id)
    UNION ALL SELECT * FROM one""",
)
def snapshot_upsert(spark, sf):
    old, new = derive(spark, sf, f"WITH {_SNAP_T} SELECT * FROM old"), derive(spark, sf, f"WITH {_SNAP_B} SELECT * FROM new")
    return upsert.upsert_snapshot(old, new, _SNAP_KEYS)


@register("roster_current", f"WITH {_SNAP_T} SELECT * FROM old WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM old)")
def roster_current(spark, sf):
    return upsert.latest_snapshot(derive(spark, sf, f"WITH {_SNAP_T} SELECT * FROM old"))


# -- key sets --------------------------------------------------------------------------

def _ids(spark, sf, name, c):
    return table(spark, sf, name).select(F.col(c).alias("id"))


@register(
    "missing_keys",
    "SELECT o_orderkey AS id FROM {orders} EXCEPT (SELECT l_orderkey FROM {lineitem} INTERSECT SELECT event_id FROM {events})",
)
def missing_keys(spark, sf):
    return sets.missing_keys(_ids(spark, sf, "orders", "o_orderkey"), _ids(spark, sf, "lineitem", "l_orderkey"), _ids(spark, sf, "events", "event_id"))


@register(
    "missing_local",
    "(SELECT c_custkey AS id FROM {customer} UNION SELECT p_partkey FROM {part}) EXCEPT (SELECT l_orderkey FROM {lineitem} INTERSECT SELECT o_custkey FROM {orders})",
)
def missing_local(spark, sf):
    return sets.missing_local(
        _ids(spark, sf, "customer", "c_custkey"), _ids(spark, sf, "part", "p_partkey"),
        _ids(spark, sf, "lineitem", "l_orderkey"), _ids(spark, sf, "orders", "o_custkey"),
    )


@register(
    "union_by_name",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM {customer} UNION ALL SELECT s_suppkey, s_name, NULL, ROUND(s_acctbal, 7) + 0.0 FROM {supplier}",
)
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return sets.union_by_name(c, s)


# -- nested ----------------------------------------------------------------------------



def _leagues(flat: DataFrame) -> DataFrame:
    """Roster sets of twelve players a team."""
    return flat.withColumn("league", F.expr("player_id DIV 96"))


@register(
    "roster_flatten",
    f"""SELECT snapshot_date, fantasy_team, player_id AS playerId, name, CASE WHEN player_id % 3 = 0 THEN true ELSE false END AS injured,
    CAST(player_id % 12 AS INTEGER) AS posRank, {r('player_id % 40 + 0.5', 'avg_points')},
    {r('CASE WHEN player_id % 6 <> 0 THEN player_id % 30 END', 'nine_pts')}, {r('CASE WHEN player_id % 6 <> 0 THEN (player_id % 7) / 8.0 END', 'nine_fgpct')},
    CAST(NULL AS DOUBLE) AS nine_reb FROM ({F4})""",
)
def roster_flatten(spark, sf):
    flat = derive(spark, sf, F4)
    pid = F.col("player_id")
    nine = F.create_map(F.lit("PTS"), (pid % 30).cast("string"), F.lit("FG%"), ((pid % 7) / 8.0).cast("string"))
    player = F.struct(
        pid.alias("playerId"), "name", (pid % 3 == 0).alias("injured"), (pid % 12).alias("posRank"),
        (pid % 40 + 0.5).alias("avg_points"), F.when(pid % 6 != 0, nine).alias("nine_cat_averages"),
    )
    docs = nested.nest_rosters(_leagues(flat), "fantasy_team", player, ["player_id"], ["league"])
    rows = nested.flatten_rosters(nested.parse_rosters(docs), date(2024, 1, 30))
    return rows.select("snapshot_date", "fantasy_team", "playerId", "name", "injured", "posRank", "avg_points", "nine_pts", "nine_fgpct", "nine_reb")


@register(
    "roster_ids_text",
    f"SELECT fantasy_team AS team, CAST(player_id AS VARCHAR) AS personid FROM ({F4})",
)
def roster_ids_text(spark, sf):
    docs = nested.nest_rosters(_leagues(derive(spark, sf, F4)), "fantasy_team", F.col("player_id"), roster=["league"])
    teams = nested.parse_roster_ids(docs)
    return teams.select("team", F.explode(text.ids_as_text("ids")).alias("personid"))


@register(
    "roster_documents",
    f"""WITH p AS (SELECT player_id // 96 AS league, fantasy_team AS team, player_id, '{{"playerId":' || player_id || ',"name":"' || name || '"}}' AS j FROM ({F4})),
    t AS (SELECT league, team, '"' || team || '":[' || string_agg(j, ',' ORDER BY player_id DESC) || ']' AS line FROM p GROUP BY league, team)
    SELECT league, '{{' || string_agg(line, ',' ORDER BY team) || '}}' AS document FROM t GROUP BY league""",
)
def roster_documents(spark, sf):
    flat = _leagues(derive(spark, sf, F4)).withColumn("place", -F.col("player_id"))
    player = F.struct(F.col("player_id").alias("playerId"), "name")
    return nested.nest_rosters(flat, "fantasy_team", player, ["place"], ["league"]).select("league", F.col("value").alias("document"))


@register(
    "json_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS absent FROM {events}",
)
def json_props(spark, sf):
    ev = table(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    k, absent = nested.expand_map("m", {"k": "k", "zz": "absent"})
    return ev.select("event_id", k.cast("bigint").alias("k"), absent)


# -- names -----------------------------------------------------------------------------

_NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim({c}))), '\b(jr|sr|ii|iii|iv|v)\b\.?', '', 'g'), '[^a-z\s]', '', 'g'), '\s+', ' ', 'g'))"
_N5 = f"""f5 AS ({F5}), l AS (SELECT left_id, left_name, {_NORM.format(c='left_name')} AS norm FROM f5),
  rt AS (SELECT {_NORM.format(c='right_name')} AS r_norm, MIN(right_name) AS right_name FROM f5 GROUP BY ALL)"""


@register(
    "normalize_names",
    f"""SELECT left_id, {_NORM.format(c='left_name')} AS norm, regexp_replace(regexp_replace(lower(trim(left_name)), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g') AS basic,
    replace(lower(trim(left_name)), ' ', '_') AS slug FROM ({F5})""",
)
def normalize_names(spark, sf):
    return derive(spark, sf, F5).select(
        "left_id", text.normalize_name("left_name").alias("norm"), text.normalize_name_basic("left_name").alias("basic"),
        text.slug("left_name").alias("slug"),
    )


def _fuzzy(spark, sf, **kw) -> DataFrame:
    f5 = derive(spark, sf, F5)
    rights = f5.select("right_name").distinct().withColumn("rid", F.col("right_name"))
    return resolve.fuzzy_match(f5, rights, "left_id", "left_name", "rid", "right_name", **kw)


@register(
    "fuzzy_exact",
    f"""WITH {_N5} SELECT l.left_id, l.left_name, rt.right_name AS right_name, 'exact_norm' AS match_type FROM l JOIN rt ON l.norm = rt.r_norm""",
)
def fuzzy_exact(spark, sf):
    return _fuzzy(spark, sf, score_floor=0.92).filter("match_type = 'exact_norm'").select("left_id", "left_name", "right_name", "match_type")


_EDIT = f"""WITH {_N5}, names AS (SELECT DISTINCT norm FROM l), sc AS (SELECT norm, right_name,
    CASE WHEN norm = r_norm THEN 1.0 ELSE 1.0 - CAST(levenshtein(norm, r_norm) AS DOUBLE) / greatest(length(norm), length(r_norm)) END AS score,
    norm = r_norm AS same FROM names, rt),
    best AS (SELECT * FROM sc WHERE score >= 0.8 - 1e-9 QUALIFY ROW_NUMBER() OVER (PARTITION BY norm ORDER BY same DESC, score DESC, right_name) = 1)
    SELECT left_id, left_name, b.right_name AS right_name, CASE WHEN b.norm IS NULL THEN 'unmatched' WHEN same THEN 'exact_norm' ELSE 'fuzzy_norm' END AS match_type,
    {r('b.score', 'match_score')} FROM l LEFT JOIN best b ON l.norm = b.norm"""


@register("fuzzy_levenshtein", _EDIT)
def fuzzy_levenshtein(spark, sf):
    out = _fuzzy(spark, sf, min_score=0.8, metric=resolve.EDIT, score_floor=0.8)
    return out.select("left_id", "left_name", "right_name", "match_type", "match_score")


# Names of the parts, and names that resemble them less and less.
_FAR = """SELECT p_partkey AS left_id, p_name AS right_name, CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, 'l', 'll') WHEN p_partkey % 5 = 1 THEN reverse(p_name)
  WHEN p_partkey % 5 = 2 THEN lower(p_type) || ' ' || p_name WHEN p_partkey % 5 = 3 THEN lower(p_type) ELSE substr(p_name, 1 + p_partkey % 4, 7) END AS left_name FROM {part}"""
_FAR_N = _N5.replace(F5, _FAR).replace("f5", "far")


@register(
    "fuzzy_best_score",
    f"""WITH {_FAR_N}, names AS (SELECT DISTINCT norm FROM l), sc AS (SELECT norm, right_name, norm = r_norm AS same,
    1.0 - CAST(levenshtein(norm, r_norm) AS DOUBLE) / greatest(length(norm), length(r_norm), 1) AS score FROM names, rt),
    best AS (SELECT * FROM sc QUALIFY ROW_NUMBER() OVER (PARTITION BY norm ORDER BY same DESC, score DESC, right_name) = 1)
    SELECT left_id, left_name, CASE WHEN score >= 0.8 - 1e-9 THEN b.right_name END AS right_name,
    CASE WHEN same THEN 'exact_norm' WHEN score >= 0.8 - 1e-9 THEN 'fuzzy_norm' ELSE 'unmatched' END AS match_type, {r('b.score', 'match_score')},
    NOT same AND score >= 0.8 - 1e-9 AND score < 0.92 AS needs_review FROM l JOIN best b ON l.norm = b.norm""",
)
def fuzzy_best_score(spark, sf):
    far = derive(spark, sf, _FAR)
    rights = far.select("right_name").distinct().withColumn("rid", F.col("right_name"))
    out = resolve.fuzzy_match(far, rights, "left_id", "left_name", "rid", "right_name", 0.8, resolve.EDIT)
    return resolve.with_review_flag(out).select("left_id", "left_name", "right_name", "match_type", "match_score", "needs_review")


@register("fuzzy_ratio")
def fuzzy_ratio(spark, sf):
    return resolve.with_review_flag(_fuzzy(spark, sf, min_score=0.92, score_floor=0.6))


# Players whose names are letters, as the games know them, and as a roster writes them.
_LETTERS = "translate(CAST({} AS STRING), '0123456789', 'abdefgilno')"
_NAMED = f"""named AS (SELECT user_id AS "personId", CAST(ts AS DATE) AS "gameDate", event_id AS "gameId",
    'Pla' || {_LETTERS.format("user_id * 31")} || CASE WHEN day(ts) > 15 THEN 'ck' ELSE '' END AS "firstName",
    CASE WHEN user_id % 50 = 49 THEN NULL ELSE 'Fam' || {_LETTERS.format("user_id * 7919 % 10007")} END AS "familyName" FROM {{events}})"""
_ROSTER = f"""roster AS (SELECT "playerId", CASE WHEN "playerId" % 5 = 0 THEN n WHEN "playerId" % 5 = 1 THEN upper(n) || ' Jr.' WHEN "playerId" % 5 = 2 THEN replace(n, 'e', 'é')
    WHEN "playerId" % 5 = 3 THEN substr(n, 1, length(n) - 1) ELSE 'Guest ' || n END AS name
  FROM (SELECT DISTINCT user_id AS "playerId", 'Pla' || {_LETTERS.format("user_id * 31")} || 'ck Fam' || {_LETTERS.format("user_id * 7919 % 10007")} AS n FROM {{events}}) AS t)"""


def _spark_names(sql: str) -> str:
    return sql.replace('"', "`")


@register(
    "player_map_named",
    f"""WITH {_NAMED}, {_ROSTER}, latest AS (SELECT CAST("personId" AS VARCHAR) AS personid, trim("firstName" || ' ' || "familyName") AS nba_name FROM named
      WHERE "familyName" IS NOT NULL QUALIFY row_number() OVER (PARTITION BY "personId" ORDER BY "gameDate" DESC, "gameId" DESC) = 1),
    rt AS (SELECT {_NORM.format(c='nba_name')} AS r_norm, min(personid) AS personid, arg_min(nba_name, personid) AS nba_name FROM latest GROUP BY ALL),
    l AS (SELECT CAST("playerId" AS VARCHAR) AS espn_player_id, name AS espn_name, {_NORM.format(c='name')} AS norm FROM roster),
    sc AS (SELECT norm, personid, nba_name, norm = r_norm AS same, 1.0 - CAST(levenshtein(norm, r_norm) AS DOUBLE) / greatest(length(norm), length(r_norm)) AS score
      FROM (SELECT DISTINCT norm FROM l), rt),
    best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY norm ORDER BY score DESC, personid) = 1)
    SELECT espn_player_id, CASE WHEN score >= 0.85 - 1e-9 THEN personid END AS personid, CASE WHEN same THEN 'exact_norm' WHEN score >= 0.85 - 1e-9 THEN 'fuzzy_norm' ELSE 'unmatched' END AS match_type,
    {r('score', 'match_score')}, espn_name, CASE WHEN score >= 0.85 - 1e-9 THEN nba_name END AS nba_name, NOT same AND score >= 0.85 - 1e-9 AND score < 0.95 AS needs_review
    FROM l JOIN best USING (norm)""",
)
def player_map_named(spark, sf):
    named = derive(spark, sf, _spark_names(f"WITH {_NAMED} SELECT * FROM named"))
    roster = derive(spark, sf, _spark_names(f"WITH {_ROSTER} SELECT * FROM roster"))
    return rosters.player_map(roster, named, 0.85, review_below=0.95, metric=resolve.EDIT).drop("created_at")


_INDEX = """SELECT p_partkey AS id, p_name AS name, p_retailprice AS total FROM {part}"""


@register(
    "name_index",
    f"""WITH p AS ({_INDEX}) SELECT CAST(id AS VARCHAR) AS personid, name, name AS name_norm, {r('total')} FROM p
    QUALIFY ROW_NUMBER() OVER (PARTITION BY name ORDER BY total DESC NULLS LAST, CAST(id AS VARCHAR)) = 1""",
)
def name_index(spark, sf):
    return resolve.name_index(derive(spark, sf, _INDEX), "id", F.col("name"), "total")


@register("search_topk")
def search_topk(spark, sf):
    index = resolve.name_index(derive(spark, sf, _INDEX), "id", F.col("name"), "total")
    found = resolve.search_candidates(index, ["smal rng", "Blue bolts", "hot gear"], k=8)
    return found.select("query", "pos", "personid", "name", "score")


# -- trades ----------------------------------------------------------------------------

_PZ = f"""pz AS (SELECT person_id AS personid, first_name AS firstname, family_name AS familyname,
  ROUND((s - AVG(s) OVER ()) / STDDEV_SAMP(s) OVER (), 6) AS totalz, ROUND((c - AVG(c) OVER ()) / STDDEV_SAMP(c) OVER (), 6) AS last_10_z,
  ROUND((n - AVG(n) OVER ()) / STDDEV_SAMP(n) OVER (), 6) AS minuteszscore
  FROM (SELECT person_id, first_name, family_name, SUM(points) AS s, CAST(SUM(clicks) AS DOUBLE) AS c, CAST(COUNT(*) AS DOUBLE) AS n FROM f1 GROUP BY ALL))
, tv AS (SELECT *, firstname || ' ' || familyname AS name, ROUND(0.6 * totalz + 0.4 * last_10_z, 6) AS v, CAST(personid AS VARCHAR) AS id FROM pz)"""
MINE, THEIRS = list(range(0, 160, 8)), list(range(1, 161, 8))
_IN = {"mine": ", ".join(map(str, MINE)), "theirs": ", ".join(map(str, THEIRS))}


def player_z(spark, sf):
    sums = f1(spark, sf).groupBy("person_id", "first_name", "family_name").agg(
        F.sum("points").alias("s"), F.sum("clicks").cast("double").alias("c"), F.count(F.lit(1)).cast("double").alias("n")
    ).withColumn("one", F.lit(1))
    z = tidy(stats.zscores(sums, {"totalz": "s", "last_10_z": "c", "minuteszscore": "n"}, ["one"]), 6)
    named = z.withColumnsRenamed({"person_id": "personid", "first_name": "firstname", "family_name": "familyname"})
    return trades.add_trade_value(named).withColumn("trade_value", F.round("trade_value", 6))


_ONE = """SELECT '1for1' AS type, a.name AS i_send, b.name AS i_get, a.v AS my_value_out, b.v AS their_value_out, b.v - a.v AS net_for_me, ABS(b.v - a.v) AS abs_diff FROM m a, t b"""
_TWO = """SELECT '2for2' AS type, a.name || ', ' || c.name AS i_send, b.name || ', ' || d.name AS i_get, a.v + c.v AS my_value_out, b.v + d.v AS their_value_out,
  (b.v + d.v) - (a.v + c.v) AS net_for_me, ABS((b.v + d.v) - (a.v + c.v)) AS abs_diff
  FROM m a JOIN m c ON a.rn < c.rn, t b JOIN t d ON b.rn < d.rn"""


def _rosters(extra: str = "") -> str:
    return ", " + ", ".join(
        f"{n} AS (SELECT *, ROW_NUMBER() OVER (ORDER BY totalz DESC, id) AS rn FROM tv WHERE personid IN ({_IN[k]}) {extra})"
        for n, k in (("m", "mine"), ("t", "theirs"))
    )


def _trade_sql(body: str, order: str, n: int, extra: str = "") -> str:
    nums = ", ".join(r(c) for c in ["my_value_out", "their_value_out", "net_for_me", "abs_diff"])
    return f"{WITH1}, {_PZ}{_rosters(extra)} SELECT type, i_send, i_get, {nums} FROM (SELECT * FROM ({body}) ORDER BY {order}, i_send, i_get LIMIT {n})"


@register("trade_1for1", _trade_sql(_ONE, "abs_diff, net_for_me DESC", 50))
def trade_1for1(spark, sf):
    return trades.suggest_trades(player_z(spark, sf), MINE, THEIRS, types=("1for1",), top_n=50)


@register("trade_2for2", _trade_sql(_TWO, "net_for_me DESC, abs_diff", 40, "AND COALESCE(minuteszscore, -999) >= -0.5"))
def trade_2for2(spark, sf):
    return trades.suggest_trades(
        player_z(spark, sf), MINE, THEIRS, mode="win_for_me", types=("2for2",), top_n=40, min_minutes_z=-0.5
    )


@register(
    "trade_pool_2for2",
    f"""{WITH1}, {_PZ}, pool AS (SELECT *, ROW_NUMBER() OVER (ORDER BY v DESC, id) AS rn FROM tv ORDER BY v DESC, id LIMIT 20)
    SELECT side_a, side_b, {r('a_v', 'side_a_value')}, {r('b_v', 'side_b_value')}, {r('d', 'abs_diff')} FROM (
    SELECT a.name || ', ' || c.name AS side_a, b.name || ', ' || e.name AS side_b, a.v + c.v AS a_v, b.v + e.v AS b_v, ABS((a.v + c.v) - (b.v + e.v)) AS d
    FROM pool a JOIN pool c ON a.rn < c.rn, pool b JOIN pool e ON b.rn < e.rn WHERE a.rn NOT IN (b.rn, e.rn) AND c.rn NOT IN (b.rn, e.rn)
    ORDER BY d, side_a, side_b LIMIT 15)""",
)
def trade_pool_2for2(spark, sf):
    return trades.suggest_2for2(player_z(spark, sf))


def _side(p: str, ids: str) -> str:
    return f"{p} AS (SELECT list(name ORDER BY totalz DESC, id) AS players, SUM(totalz) AS z, SUM(last_10_z) AS l, SUM(v) AS v FROM tv WHERE personid IN ({ids}))"


def _eval_row(label: str, g: str, t: str) -> str:
    return f"""SELECT '{label}' AS side, array_to_string({g}.players, '; ') AS gives, {r(f'{g}.z', 'gives_totalz')}, {r(f'{g}.l', 'gives_last_10_z')},
      {r(f'{g}.v', 'gives_trade_value')}, array_to_string({t}.players, '; ') AS gets, {r(f'{t}.v', 'gets_trade_value')}, {r(f'{t}.v - {g}.v', 'net_trade_value')} FROM a, b"""


@register(
    "trade_eval",
    f"{WITH1}, {_PZ}, {_side('a', '3, 7')}, {_side('b', '4, 10, 11')} {_eval_row('side_a', 'a', 'b')} UNION ALL {_eval_row('side_b', 'b', 'a')}",
)
def trade_eval(spark, sf):
    out = trades.evaluate_trade(player_z(spark, sf), [3, 7], [4, 10, 11])
    return out.select(
        "side", F.array_join("gives_players", "; ").alias("gives"), "gives_totalz", "gives_last_10_z", "gives_trade_value",
        F.array_join("gets_players", "; ").alias("gets"), "gets_trade_value", "net_trade_value",
    )


# -- text, dates, ids ------------------------------------------------------------------

@register(
    "season_label",
    """SELECT o_orderkey, CAST(s AS VARCHAR) || '-' || right(CAST(s + 1 AS VARCHAR), 2) AS season,
    CAST(s6 AS VARCHAR) || '-' || right(CAST(s6 + 1 AS VARCHAR), 2) AS season_june FROM (SELECT o_orderkey,
    year(o_orderdate) - CASE WHEN month(o_orderdate) <= 7 THEN 1 ELSE 0 END AS s,
    year(o_orderdate) - CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 0 END AS s6 FROM {orders})""",
)
def season_label(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.season_label("o_orderdate").alias("season"), dates.season_label("o_orderdate", 6).alias("season_june")
    )


@register(
    "calendar_parts",
    """SELECT o_orderkey, strftime(o_orderdate, '%G-%V') AS iso_week, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
    CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS week_end, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS day_no,
    CAST(o_orderdate AS DATE) AS packed FROM {orders}""",
)
def calendar_parts(spark, sf):
    o = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    return o.select(
        "o_orderkey", dates.iso_year_week("d").alias("iso_week"), dates.week_start("d").alias("week_start"),
        dates.week_end("d").alias("week_end"), dates.days_between(F.lit(date(1995, 1, 1)), "d").alias("day_no"),
        dates.date_from_int(F.date_format("d", "yyyyMMdd").cast("bigint")).alias("packed"),
    )


@register(
    "zfill_ids",
    "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(10, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS id10, "
    "lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(3, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS id3 FROM {orders}",
)
def zfill_ids(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text.pad_id("o_orderkey").alias("id10"), text.pad_id("o_orderkey", 3).alias("id3")
    )


@register(
    "text_formatters",
    """SELECT event_id, CASE WHEN value >= 10 THEN printf('%.0f', round_even(value, 0)) WHEN value >= 1 THEN printf('%.2f', round_even(value, 2))
    ELSE printf('%.3f', round_even(value, 3)) END AS shown,
    'SZN 22024 | Week ' || CAST(week(ts) AS VARCHAR) || ' | ' || CAST(CAST(ts AS DATE) AS VARCHAR) || ' → ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS label,
    CAST(user_id AS VARCHAR) || event_type AS joined FROM {events}""",
)
def text_formatters(spark, sf):
    ev = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    return ev.select(
        "event_id", text.format_magnitude("value").alias("shown"),
        text.week_label(F.lit(22024), F.weekofyear("d"), "d", "d").alias("label"),
        text.concat_text("user_id", F.lit(None), "event_type").alias("joined"),
    )


@register(
    "parse_ids",
    "SELECT x AS id, COUNT(*) AS n FROM (SELECT unnest(string_split(replace(t, ',', ' '), ' ')) AS x FROM "
    "(SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || ', ' || CAST(o_custkey AS VARCHAR) || ',' || o_orderstatus AS t FROM {orders})) WHERE x <> '' GROUP BY x",
)
def parse_ids(spark, sf):
    o = table(spark, sf, "orders").select(
        F.concat(text.pad_id("o_orderkey"), F.lit(", "), F.col("o_custkey").cast("string"), F.lit(","), F.col("o_orderstatus")).alias("t")
    )
    return text.parse_ids(o, "t", "id").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@register(
    "typed_casts",
    f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 = 0 THEN 'n/a' WHEN l_partkey % 5 = 1 THEN CAST(l_partkey AS STRING) || '.0'
      ELSE CAST(l_partkey AS STRING) END AS t, CASE WHEN l_partkey % 7 = 0 THEN '2024-13-45' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS d FROM {{lineitem}})
    SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST(t AS BIGINT) AS as_long, {r('TRY_CAST(t AS DOUBLE)', 'as_double')}, TRY_CAST(d AS DATE) AS as_date FROM x""",
)
def typed_casts(spark, sf):
    part = F.col("l_partkey")
    t = F.when(part % 5 == 0, "n/a").when(part % 5 == 1, F.concat(part.cast("string"), F.lit(".0"))).otherwise(part.cast("string"))
    d = F.when(part % 7 == 0, "2024-13-45").otherwise(F.col("l_shipdate").cast("date").cast("string"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", casts.try_long(t).alias("as_long"), casts.try_double(t).alias("as_double"),
        casts.try_date(d).alias("as_date"),
    )
