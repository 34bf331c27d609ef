"""Keyed merges as pure ``(target, batch) -> DataFrame`` functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import all_text, any_null, lower_columns, require_columns

from .series import latest_per


def key_columns(endpoint: str, is_team: bool) -> tuple[str, list[str]]:
    """Raw table name and natural key of an endpoint's team or player rows."""
    endpoint = endpoint.lower()
    if not is_team:
        return f"players_{endpoint}", ["gameid", "teamid", "personid"]
    extra = ["startersbench"] if endpoint == "traditional" else []
    return f"teams_{endpoint}", ["gameid", "teamid", *extra]


LOG_KEYS = ["game_id", "team_id"]


def upsert_delete_insert(target: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Replace target rows whose key occurs in the batch, then add the whole batch.

    Everything is text. Columns new in the batch are added; columns the batch lacks
    become NULL on replaced rows. NULL keys match nothing, and repeated keys inside
    the batch are all kept.
    """
    keys = [k.lower() for k in keys]
    batch = all_text(lower_columns(batch))
    require_columns(batch, keys)
    if target is None:
        return batch
    hit = batch.select(*keys).distinct()
    return (
        all_text(lower_columns(target))
        .join(hit, keys, "left_anti")
        .unionByName(batch, allowMissingColumns=True)
    )


def upsert_merge_coalesce(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows take the batch value where it is known; unmatched batch rows are added.

    The batch must be unique by key. A left join plus an anti join is used rather than
    one full outer join, because adaptive execution can split a hot key only on the
    streamed side of the former two.
    """
    require_columns(batch, keys)
    values = [c for c in batch.columns if c not in keys]
    side = batch.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in values])
    merged = target.join(side, keys, "left").select(
        *[
            (F.coalesce(F.col(f"__b_{c}"), F.col(c)) if c in values else F.col(c)).alias(c)
            for c in target.columns
        ],
        *[F.col(f"__b_{c}").alias(c) for c in values if c not in target.columns],
    )
    new = batch.join(target.select(*keys).distinct(), keys, "left_anti")
    return merged.unionByName(new, allowMissingColumns=True)


def append_new(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Add batch rows whose key the target does not hold yet."""
    stored = target.select(key).distinct()
    return target.unionByName(batch.join(stored, key, "left_anti"), allowMissingColumns=True)


def replace_key(target: DataFrame, batch: DataFrame, key: str, value) -> DataFrame:
    """Drop the rows of one key, then add the batch."""
    kept = target.filter(~F.col(key).eqNullSafe(F.lit(value)))
    return kept.unionByName(batch, allowMissingColumns=True)


def dedupe(df: DataFrame, keys: list[str], newest: list[str] | None = None) -> DataFrame:
    """One row per key: the newest, or the greatest remaining values if no order is given.

    Rows with a NULL key part are no duplicates of each other and all stay.
    """
    order = newest or [c for c in df.columns if c not in keys]
    keyed = latest_per(df.filter(~any_null(keys)), keys, order) if order else df.filter(~any_null(keys)).distinct()
    return keyed.unionByName(df.filter(any_null(keys)))


SNAPSHOT_KEYS = ["snapshot_date", "fantasy_team", "playerId"]


def upsert_snapshot(
    target: DataFrame | None, batch: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Typed keyed replace of a dated snapshot; the batch is reduced to one row per key."""
    keys = keys or SNAPSHOT_KEYS
    batch = dedupe(batch, keys)
    if target is None:
        return batch
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def latest_snapshot(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Rows of the newest date only (scalar subquery, so it can prune date partitions)."""
    newest = df.select(F.max(date).alias("d"))
    return df.filter(F.col(date) == newest.scalar())


