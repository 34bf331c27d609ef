"""Tables laid out by season and day: keyed upserts that rewrite only the days they touch.

A raw row's natural partition follows from its key: the log says in which season and on which day a
game was played. A layout file beside the partitions holds what the table was written with (keys,
partition columns, columns in order); every write checks it, and a read takes its schema from it
instead of opening files.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.casts import all_text, lower_columns, require_columns, try_date
from statmart.operators.upsert import LOG_KEYS, key_columns
from statmart.session import discard, materialise

SEASON, DAY = "season", "day"
PARTITION = [SEASON, DAY]
LAYOUT = "_layout.json"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def layout_of(spark: SparkSession, path: str) -> dict | None:
    """What the table at ``path`` was written with; None if it does not exist."""
    file, fs = _path(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put_layout(spark: SparkSession, path: str, layout: dict) -> None:
    """Replace the layout file by a rename, so that no reader finds half of it."""
    file, fs = _path(spark, f"{path.rstrip('/')}/{LAYOUT}")
    new, _ = _path(spark, f"{path.rstrip('/')}/{LAYOUT}.new")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(json.dumps(layout, indent=1).encode()))
    finally:
        stream.close()
    fs.delete(file, False)
    if not fs.rename(new, file):
        raise OSError(f"cannot write {file}")


def _check(layout: dict, keys: list[str], path: str) -> None:
    if layout["keys"] != keys or layout["partition"] != PARTITION:
        raise ValueError(f"{path} was written with keys {layout['keys']} by {layout['partition']}, not {keys} by {PARTITION}")


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField(SEASON, T.StringType()), T.StructField(DAY, T.DateType())])


def read_days(spark: SparkSession, path: str, start: date | None = None, end: date | None = None, placed: bool = False) -> DataFrame:
    """A table laid out by day, all or the days ``start`` to ``end``; only their folders are read.

    A column that a file lacks reads as NULL. ``placed`` keeps season and day.
    """
    layout = layout_of(spark, path)
    if layout is None:
        raise FileNotFoundError(f"{path} has no {LAYOUT}")
    out = spark.read.schema(_schema(layout["columns"])).parquet(path)
    if start is not None:
        out = out.filter(F.col(DAY) >= F.lit(start))
    if end is not None:
        out = out.filter(F.col(DAY) <= F.lit(end))
    return out if placed else out.drop(*PARTITION)


def _partitions(df: DataFrame) -> list[tuple]:
    """The distinct partitions of a frame: as many as the days that it has."""
    return [tuple(r) for r in df.select(*PARTITION).distinct().collect()]


def _in(partitions: list[tuple]) -> Column:
    out = F.lit(False)
    for season in {s for s, _ in partitions}:
        days = [d for s, d in partitions if s == season]
        known = [d for d in days if d is not None]
        of_day = F.col(DAY).isin(known) if known else F.lit(False)
        if None in days:
            of_day = of_day | F.col(DAY).isNull()
        out = out | (F.col(SEASON).eqNullSafe(F.lit(season)) & of_day)
    return out


def upsert_days(batch: DataFrame, path: str, keys: list[str]) -> list[tuple]:
    """Keyed upsert (as :func:`operators.upsert.upsert_delete_insert`) of rows that carry ``season`` and ``day``.

    The first column of ``keys`` is the game, which decides a row's place: a replaced row lies in the
    batch's partitions or, if the log has moved its game to another day, in those where a scan of that
    one column over the batch's seasons finds it. These and no other partitions are rewritten.
    Returns them.
    """
    spark = batch.sparkSession
    keys = [k.lower() for k in keys]
    layout = layout_of(spark, path)
    if layout is not None:
        _check(layout, keys, path)
    season, day = F.col(SEASON).cast("string"), F.col(DAY).cast("date")
    text = all_text(lower_columns(batch.drop(*PARTITION)))
    require_columns(text, keys)
    batch = all_text(lower_columns(batch)).withColumns({SEASON: season, DAY: day})
    batch = batch.select(*text.columns, *PARTITION)
    columns = list(text.columns)
    if layout is None:
        # Nothing to replace: the batch goes straight to its partitions.
        _put_layout(spark, path, {"keys": keys, "partition": PARTITION, "columns": columns})
        _write(batch, path)
        return sorted(_partitions(read_days(spark, path, placed=True)), key=str)
    batch = materialise(batch, "upsert-batch")
    touched = set(_partitions(batch))
    columns = layout["columns"] + [c for c in columns if c not in layout["columns"]]
    stored = read_days(spark, path, placed=True)
    seasons = {season for season, _ in touched}
    # A game keeps its season, so its old rows are looked for there; one without a season, everywhere.
    near = stored if None in seasons else stored.filter(F.col(SEASON).isin(sorted(seasons)) | F.col(SEASON).isNull())
    touched |= set(_partitions(near.select(keys[0], *PARTITION).join(batch.select(keys[0]).distinct(), keys[0], "left_semi")))
    if not touched:
        return []
    old = stored.filter(_in(sorted(touched, key=str)))
    kept = old.join(batch.select(*keys).distinct(), keys, "left_anti")
    merged = materialise(kept.unionByName(batch, allowMissingColumns=True), "upsert-merged")
    emptied = touched - set(_partitions(merged))
    if columns != layout["columns"]:
        # First, so that no crash leaves rows which a reader does not know of.
        _put_layout(spark, path, {"keys": keys, "partition": PARTITION, "columns": columns})
    _write(merged.select(*columns, *PARTITION), path)
    for part in emptied:
        folder, fs = _path(spark, f"{path.rstrip('/')}/{_folder(part)}")
        fs.delete(folder, True)
    discard(merged)
    discard(batch)
    return sorted(touched, key=str)


def _write(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", *PARTITION).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(path)
    )


def _folder(part: tuple) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{c}={none if v is None else v.isoformat() if isinstance(v, date) else v}" for c, v in zip(PARTITION, part))


def placed_by_log(batch: DataFrame, log: DataFrame, game: str = "gameid") -> DataFrame:
    """``batch`` with the season and day at which the log has its game; NULL where it has none."""
    games = log.groupBy(F.col("game_id").alias("__game")).agg(F.max("season_id").alias(SEASON), F.max(try_date("game_date")).alias(DAY))
    return batch.join(games, batch[game] == games["__game"], "left").drop("__game")


def upsert_log(log: DataFrame, path: str) -> list[tuple]:
    """Upsert game-log rows by game and team; a log row says itself when its game was played."""
    log = lower_columns(log)
    return upsert_days(log.withColumns({SEASON: F.col("season_id"), DAY: try_date("game_date")}), path, LOG_KEYS)


def upsert_endpoint_days(endpoint: str, teams: DataFrame | None, players: DataFrame | None, log: DataFrame, root: str) -> dict[str, list[tuple]]:
    """Upsert one endpoint's team and player rows, each into the days of its games."""
    written = {}
    for frame, is_team in ((teams, True), (players, False)):
        if frame is not None:
            name, keys = key_columns(endpoint, is_team)
            written[name] = upsert_days(placed_by_log(lower_columns(frame), log), f"{root.rstrip('/')}/{name}", keys)
    return written
