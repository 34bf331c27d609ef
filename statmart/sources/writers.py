"""Sinks: full overwrite, date-range refresh, bucketed keyed upsert, CSV outputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.casts import all_text, lower_columns, require_columns
from statmart.operators.upsert import key_columns, upsert_delete_insert
from statmart.session import discard, materialise

from .readers import _exists

PART = "part"


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the whole table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def row_count(df: DataFrame) -> int:
    return df.count()


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows to a CSV directory; every file carries the header."""
    df.write.mode("append").option("header", True).csv(path)


def refresh_range(
    build: Callable[[], DataFrame], start: date, end: date, path: str, time_col: str = "gameDate"
) -> None:
    """Rebuild the days ``start..end`` of a table partitioned by day.

    The filter is on the output only, because windows need earlier rows. What ``build``
    gives is written once, by day into a hidden folder of the table, so ``build`` may read the
    table itself. Its days' folders are then swapped in, and days of the range that come out
    empty lose their old rows. The rebalance hint groups rows by day for the write and lets
    adaptive execution split a heavy day.
    """
    built = build().filter(F.col(time_col).between(F.lit(start), F.lit(end)))
    spark, path = built.sparkSession, path.rstrip("/")
    fresh = f"{path}/_fresh-{uuid.uuid4().hex}"
    built.hint("rebalance", F.col(time_col)).write.partitionBy(time_col).parquet(fresh)
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    days = partition_days(spark, fresh, time_col)
    for day in {*days, *partition_days(spark, path, time_col, start, end)}:
        name = f"{time_col}={day.isoformat()}"
        _delete(spark, f"{path}/{name}")
        if day in days and not fs.rename(p(f"{fresh}/{name}"), p(f"{path}/{name}")):
            raise OSError(f"cannot swap in {path}/{name}")
    _delete(spark, fresh)


def partition_days(spark: SparkSession, path: str, time_col: str, start: date = date.min, end: date = date.max) -> list[date]:
    """Days in the range that have a directory (listing only; bounded by the range)."""
    if not _exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    days = [date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{time_col}=") and n[-1].isdigit()]
    return [d for d in days if start <= d <= end]


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A bucketed raw table; buckets written before a column existed read it as NULL."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(PART)


def upsert_table(batch: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """Keyed upsert into an all-text table on files, rewriting only the buckets it touches.

    Rows lie in directories by hash of the first key, so a replaced row is always in the
    bucket of the row that replaces it. Only the bucket numbers of the batch (at most
    ``buckets``) come to the driver.
    """
    spark = batch.sparkSession
    keys = [k.lower() for k in keys]
    batch = all_text(lower_columns(batch))
    require_columns(batch, keys)
    part = F.pmod(F.xxhash64(keys[0]), F.lit(buckets)).cast("int")
    exists = _exists(spark, path)
    if not exists:
        merged = batch
    else:
        # Read three times: a stream's batch would run its state each time.
        batch = materialise(batch, "upsert-batch")
        touched = [r[0] for r in batch.select(part.alias(PART)).distinct().collect()]
        if not touched:
            return discard(batch)
        stored = spark.read.option("mergeSchema", True).parquet(path)
        target = stored.filter(F.col(PART).isin(touched)).drop(PART)
        merged = upsert_delete_insert(target, batch, keys)
    (
        merged.withColumn(PART, part)
        .hint("rebalance", F.col(PART))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(path)
    )
    if exists:
        discard(batch)


def upsert_endpoint(
    endpoint: str, teams: DataFrame | None, players: DataFrame | None, root: str, buckets: int = 64
) -> None:
    """Upsert one endpoint's team and player rows into their raw tables."""
    for frame, is_team in ((teams, True), (players, False)):
        if frame is not None:
            name, keys = key_columns(endpoint, is_team)
            upsert_table(frame, f"{root.rstrip('/')}/{name}", keys, buckets)


def write_game(df: DataFrame, path: str, key: str, value: str, overwrite: bool) -> None:
    """Store one game's rows as its own partition; without ``overwrite`` they are added."""
    out = df.filter(F.col(key) == value)
    (
        out.write.mode("overwrite" if overwrite else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(key)
        .csv(path)
    )


def write_trade_output(df: DataFrame, my_team: str, their_team: str, out_dir: str, now: datetime | None = None) -> str:
    """Write a trade list twice: under a time-stamped name and as ``_latest``."""
    def name(team: str) -> str:
        return team.strip().lower().replace(" ", "_")

    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    base = f"{out_dir.rstrip('/')}/trades_{name(my_team)}_vs_{name(their_team)}"
    found = materialise(df, "trades")
    for suffix in (stamp, "latest"):
        found.write.mode("overwrite").option("header", True).csv(f"{base}_{suffix}")
    discard(found)
    return f"{base}_{stamp}"
