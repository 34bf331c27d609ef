"""Sources, sinks, incremental builds and the ingest stream: each query writes whole tables to the
shared folder by the operator it is named for and returns what a reader then finds."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions import casts
from statmart.operators import nested, upsert
from statmart.plans import daily
from statmart.plans import measures as m
from statmart.session import scratch_dir
from statmart.sources import daily as by_day
from statmart.sources import readers, writers
from statmart.sources.schemas import ENDPOINTS
from statmart.streaming.ingest import ingest_stream

from . import models_sql as q
from .generic import _leagues
from .inputs import F4, derive, duck, layers, r, raw_ctes, raw_table, table, tidy

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str, digits: int = 7):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf: tidy(fn(spark, sf), digits)
        ORACLES[name] = duck(sql)
        return fn

    return wrap


def folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/statmart/{name}-{uuid.uuid4().hex}"


# -- raw tables by season and day ------------------------------------------------------

LATE = date(2024, 2, 20)
_LATE = f"DATE '{LATE}'"


def _raw(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], DataFrame]:
    found = layers(spark, sf)
    return found, raw_table(found, "log_table")


@register(
    "raw_upsert_days",
    f"""WITH {raw_ctes()}, g AS (SELECT game_id, max(season_id) AS season, max(CAST(game_date AS DATE)) AS day FROM log_table GROUP BY game_id)
    SELECT p.gameid, p.teamid, p.personid, CASE WHEN day >= {_LATE} THEN p.blocks ELSE 'old' END AS blocks,
      CASE WHEN day >= {_LATE} THEN p.foulsdrawn END AS foulsdrawn, season, day FROM players_misc p LEFT JOIN g ON p.gameid = g.game_id""",
)
def raw_upsert_days(spark, sf):
    """The whole table with old values, then the late days as they are: K01, K03, K06."""
    found, log = _raw(spark, sf)
    rows, root = raw_table(found, "players_misc"), folder(spark, "raw")
    by_day.upsert_endpoint_days("misc", None, rows.withColumn("blocks", F.lit("old")).drop("foulsdrawn"), log, root)
    late = rows.join(log.filter(casts.try_date("game_date") >= F.lit(LATE)).select(F.col("game_id").alias("gameid")).distinct(), "gameid", "left_semi")
    by_day.upsert_endpoint_days("misc", None, late, log, root)
    out = by_day.read_days(spark, f"{root}/players_misc", placed=True)
    return out.select("gameid", "teamid", "personid", "blocks", "foulsdrawn", "season", "day")


@register(
    "log_upsert",
    f"WITH {raw_ctes()} SELECT game_id, team_id, wl, CASE WHEN CAST(game_date AS DATE) >= {_LATE} THEN pts ELSE 'old' END AS pts FROM log_table",
)
def log_upsert(spark, sf):
    """Log rows replaced by game and team."""
    _, log = _raw(spark, sf)
    path = folder(spark, "log")
    by_day.upsert_log(log.withColumn("pts", F.lit("old")), path)
    by_day.upsert_log(log.filter(casts.try_date("game_date") >= F.lit(LATE)), path)
    return by_day.read_days(spark, path).select("game_id", "team_id", "wl", "pts")


@register(
    "endpoint_upsert",
    f"""WITH {raw_ctes()} SELECT gameid, teamid, startersbench, CASE WHEN startersbench = 'Bench' THEN points ELSE 'old' END AS points, CAST(3 AS BIGINT) AS n_keys FROM teams_traditional""",
)
def endpoint_upsert(spark, sf):
    """K05 and the bucketed form of K06: the halves of a team are told apart by the third key."""
    found, _ = _raw(spark, sf)
    rows, root = raw_table(found, "teams_traditional"), folder(spark, "raw")
    writers.upsert_endpoint("traditional", rows.withColumn("points", F.lit("old")), None, root, 8)
    writers.upsert_endpoint("traditional", rows.filter("startersbench = 'Bench'"), None, root, 8)
    keys = upsert.key_columns("traditional", True)[1]
    out = writers.read_raw(spark, f"{root}/teams_traditional").select("gameid", "teamid", "startersbench", "points")
    return out.withColumn("n_keys", F.lit(len(keys)).cast("long"))


# -- the incremental daily build -------------------------------------------------------

_BUILT: dict[tuple[str, str], str] = {}
FIRST, BORDER, LAST = date(2024, 1, 1), date(2024, 2, 17), date(2024, 2, 20)


def daily_root(spark: SparkSession, sf: str) -> str:
    """Raw tables by day and the daily tables over them, built in steps: up to a border, the days after
    it, then three days in the middle once more, which carries on to the end. Built once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUILT:
        root = folder(spark, "daily")
        found, log = _raw(spark, sf)
        by_day.upsert_log(log, f"{root}/raw/log_table")
        for e in ENDPOINTS:
            by_day.upsert_endpoint_days(e, None, raw_table(found, f"players_{e}"), log, f"{root}/raw")
        daily.refresh(spark, root, FIRST, BORDER)
        daily.refresh(spark, root, date(2024, 2, 18), date(2024, 12, 31))
        daily.refresh(spark, root, date(2024, 2, 18), LAST)
        _BUILT[key] = root
    return _BUILT[key]


_GAME = [*q.GAME]


@register("refresh_base_stats", q.final("base_stats", [*_GAME, "doubleDouble"], "minutes points assists steals blocks freeThrowsPercentage".split()))
def refresh_base_stats(spark, sf):
    out = daily.stored(spark, daily_root(spark, sf), "base_stats")
    return out.select(*_GAME, "doubleDouble", "minutes", "points", "assists", "steals", "blocks", "freeThrowsPercentage")


@register("refresh_averages", q.final("averages", _GAME, ["average_played_flag", *q.AVGS]))
def refresh_averages(spark, sf):
    return daily.stored(spark, daily_root(spark, sf), "averages").select(*_GAME, "average_played_flag", *q.AVGS)


@register("refresh_last_10", q.final("averages_last_10", [*_GAME, "games_in_window"], list(m.LAST10_NAMES.values())))
def refresh_last_10(spark, sf):
    return daily.stored(spark, daily_root(spark, sf), "averages_last_10").select(*_GAME, "games_in_window", *m.LAST10_NAMES.values())


@register("refresh_performance", q.final("performance_delta", q.DELTA_KEEP, q.DELTA_NUM))
def refresh_performance(spark, sf):
    return daily.stored(spark, daily_root(spark, sf), "performance_delta").select(*q.DELTA_KEEP, *q.DELTA_NUM)


@register("refresh_range_days", f"SELECT o_orderkey, {r('o_totalprice')}, CASE WHEN o_orderdate >= DATE '1997-01-01' THEN 'new' ELSE 'old' END AS tag FROM {{orders}}")
def refresh_range_days(spark, sf):
    """All days, then those from 1997 on once more. Days are months here, as folders are many."""
    path = folder(spark, "refresh")
    month = F.trunc("o_orderdate", "month").alias("month")
    build = lambda tag: table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(tag).alias("tag"), month)
    writers.refresh_range(lambda: build("old"), date(1900, 1, 1), date(2999, 1, 1), path, "month")
    writers.refresh_range(lambda: build("new"), date(1997, 1, 1), date(2999, 1, 1), path, "month")
    return spark.read.parquet(path).drop("month")


# -- the ingest stream -----------------------------------------------------------------

_VERSIONS = """SELECT CAST(c_custkey AS STRING) AS id, CAST(v AS STRING) AS version, c_name || ' v' || CAST(v AS STRING) AS name, CAST(c_nationkey + v AS STRING) AS nation
  FROM {customer} CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 UNION ALL SELECT 3) AS t"""


@register(
    "ingest_shuffled",
    f"SELECT id, version, name, nation FROM ({_VERSIONS}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1",
)
def ingest_shuffled(spark, sf):
    """Three versions of every row in files in any order, all of them twice, a few files a batch."""
    files, target, checkpoint = (folder(spark, x) for x in ("arriving", "ingested", "checkpoint"))
    rows = derive(spark, sf, _VERSIONS)
    dealt = rows.withColumn("f", F.pmod(F.xxhash64("id", "version"), F.lit(5)))
    for copy in range(2):
        shuffled = dealt.repartition(5, (F.col("f") + copy) % 5).drop("f")
        shuffled.write.mode("append").option("header", True).csv(files)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in rows.columns])
    ingest_stream(spark, files, target, ["id"], schema, checkpoint, 4, max_files=3, version="version").awaitTermination()
    return writers.read_raw(spark, target).select("id", "version", "name", "nation")


# -- sources ---------------------------------------------------------------------------

_ORDER_FILES = {
    "a": ["o_orderkey", "o_custkey", "o_orderstatus"],
    "b": ["o_orderstatus", "o_totalprice", "o_orderkey"],
    "c": ["o_orderkey", "o_orderpriority"],
}
_ORDER_TYPES = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
     T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderpriority", T.StringType())]
)


@register(
    "csv_union_by_name",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS o_orderstatus,
    {r('CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END', 'o_totalprice')}, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM {{orders}}""",
)
def csv_union_by_name(spark, sf):
    """The orders dealt to files with three headers."""
    path = folder(spark, "csv")
    orders = table(spark, sf, "orders")
    for i, columns in enumerate(_ORDER_FILES.values()):
        orders.filter(F.col("o_orderkey") % 3 == i).select(*columns).repartition(4).write.mode("append").option("header", True).csv(path)
    return readers.read_csv_union_by_name(spark, f"{path}/*.csv", _ORDER_TYPES)


@register("csv_seed", "SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS region, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code FROM {nation}")
def csv_seed(spark, sf):
    """A typed seed, and ids that keep their zeros."""
    seed, cache = folder(spark, "seed"), folder(spark, "cache")
    nation = table(spark, sf, "nation")
    writers.append_csv(nation.select("n_nationkey", "n_name"), seed)
    writers.append_csv(nation.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"), F.col("n_regionkey").alias("region")), cache)
    left = readers.read_seed(spark, seed, T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())]))
    right = readers.read_text_csv(spark, cache)
    return left.join(right, left["n_nationkey"] == right["code"].cast("int")).select("n_nationkey", "n_name", "region", "code")


@register(
    "roster_json_files",
    f"SELECT snapshot_date, fantasy_team, player_id AS \"playerId\", name FROM ({F4})",
)
def roster_json_files(spark, sf):
    """Roster documents as JSON lines, one for each league."""
    path = folder(spark, "rosters")
    player = F.struct(F.col("player_id").alias("playerId"), "name")
    docs = nested.nest_rosters(_leagues(derive(spark, sf, F4)), "fantasy_team", player, ["player_id"], ["league"])
    docs.select("value").write.text(path)
    rows = nested.flatten_rosters(readers.read_rosters_json(spark, path, lines=True), date(2024, 1, 30))
    return rows.select("snapshot_date", "fantasy_team", "playerId", "name")


@register("table_replace", "SELECT s_suppkey, s_name, s_nationkey, (SELECT count(*) FROM {supplier}) AS n FROM {supplier}")
def table_replace(spark, sf):
    """A table written, replaced whole, counted and scanned by its name."""
    root = folder(spark, "tables")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    writers.overwrite_table(rows.withColumn("s_name", F.lit("old")).unionAll(rows), f"{root}/base/suppliers")
    writers.overwrite_table(rows, f"{root}/base/suppliers")
    found = readers.table(spark, "base.suppliers", root)
    return found.withColumn("n", F.lit(writers.row_count(found)).cast("long"))


# -- CSV sinks -------------------------------------------------------------------------

@register(
    "game_csv",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'new' ELSE 'old' END AS tag FROM {customer}",
)
def game_csv(spark, sf):
    """Every segment added as its own partition, then one of them overwritten."""
    path = folder(spark, "games")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_mktsegment")
    for (segment,) in rows.select("c_mktsegment").distinct().collect():
        writers.write_game(rows.withColumn("tag", F.lit("old")), path, "c_mktsegment", segment, overwrite=False)
    writers.write_game(rows.withColumn("tag", F.lit("new")), path, "c_mktsegment", "BUILDING", overwrite=True)
    return spark.read.option("header", True).csv(path).select("id", "c_mktsegment", "tag")


@register("trade_csv", f"""SELECT s_name AS i_send, {r('s_acctbal', 'net_for_me')}, CAST(2 AS BIGINT) AS copies FROM {{supplier}}""")
def trade_csv(spark, sf):
    """A list written under its time and as the latest; the older latest is gone."""
    root = folder(spark, "trades")
    rows = table(spark, sf, "supplier").select(F.col("s_name").alias("i_send"), F.col("s_acctbal").alias("net_for_me"))
    writers.write_trade_output(rows.unionAll(rows), "Mine", "The Others", root)
    stamped = writers.write_trade_output(rows, " Mine", "The Others", root)
    read = lambda path: spark.read.option("header", True).csv(path).withColumn("net_for_me", casts.try_double("net_for_me"))
    both = read(stamped).unionAll(read(f"{root}/trades_mine_vs_the_others_latest"))
    return both.groupBy("i_send", "net_for_me").agg(F.count("*").alias("copies"))


@register(
    "numeric_columns",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r("TRY_CAST(CASE WHEN l_partkey % 5 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE)", 'qty')} FROM {{lineitem}}""",
)
def numeric_columns(spark, sf):
    """P21."""
    messy = F.when(F.col("l_partkey") % 5 == 0, "n/a").otherwise(F.col("l_quantity").cast("string"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", messy.alias("qty"))
    return casts.to_numeric(rows, ["QTY", "absent"])
