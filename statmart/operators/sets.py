"""Set algebra over key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name; a column missing from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def keys_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def keys_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.subtract(b)


def keys_in_either(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def missing_keys(wanted: DataFrame, stored_a: DataFrame, stored_b: DataFrame) -> DataFrame:
    """Wanted keys not stored in **both** places."""
    return keys_missing(wanted, keys_in_both(stored_a, stored_b))


def missing_local(
    local_a: DataFrame, local_b: DataFrame, stored_a: DataFrame, stored_b: DataFrame
) -> DataFrame:
    """Keys held locally in either frame but not stored in both tables."""
    return keys_missing(keys_in_either(local_a, local_b), keys_in_both(stored_a, stored_b))
