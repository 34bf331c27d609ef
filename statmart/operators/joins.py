"""Join shapes used by the marts.

No join here carries a broadcast hint, and the wide chain is always merged. Sides that Spark can size from files are
broadcast by its own threshold; sides known only at run time are sized by adaptive
execution, which also splits skewed partitions of the streamed side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.casts import try_long


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def prefixed(df: DataFrame, prefix: str, keep: list[str] = ()) -> DataFrame:
    """Prefix every column but ``keep``, so that wide sources can be joined by name."""
    return df.toDF(*[c if c in keep else f"{prefix}{c}" for c in df.columns])


def combine_star(
    log: DataFrame, sources: dict[str, DataFrame], log_keys: dict[str, Column], source_keys: dict[str, dict[str, Column]]
) -> DataFrame:
    """Left-join every source to the log on the same computed keys.

    Key expressions (casts) are evaluated once per side. All joins use one key list,
    so the log is shuffled once and each join reuses that layout.
    """
    names = list(log_keys)
    out = log.withColumns(log_keys)
    for name, source in sources.items():
        side = prefixed(source, f"{name}_").withColumns(
            {f"{name}__{k}": c for k, c in source_keys[name].items()}
        )
        cond = [out[k] == side[f"{name}__{k}"] for k in names]
        out = out.join(side, cond, "left").drop(*[f"{name}__{k}" for k in names])
    return out.drop(*names)


def combine_chain(
    log: DataFrame,
    tables: list[tuple[str, DataFrame]],
    first_keys: tuple[dict[str, Column], dict[str, Column]],
    link_keys: dict[str, str],
    keep_links: bool = False,
) -> DataFrame:
    """Left-join a chain: each table is matched to the keys of the table before it.

    ``first_keys`` are the key expressions of (log, first table); ``link_keys`` maps a
    link name to the text id column read as bigint in every table. A row missing
    from one table therefore also misses everything later in the chain.

    Where the table before has a row its keys equal those of the first table, so every link
    compares the first table's keys and asks only whether the table before has a row. All
    links then share one layout: the growing row is dealt out and sorted once, and rows that
    a table lacks stay spread rather than meet in the partition of NULL. ``keep_links``
    leaves that layout's columns, :func:`link_columns`, in the result.
    """
    name, table = tables[0]
    side = prefixed(table, f"{name}_").withColumns(
        {f"{name}__{k}": try_long(f"{name}_{c}") for k, c in link_keys.items()}
    )
    side = side.withColumns({f"__f_{k}": c for k, c in first_keys[1].items()})
    logged = log.withColumns({f"__l_{k}": c for k, c in first_keys[0].items()})
    # A log row has many rows in the first table, which the left side of an outer join would gather by
    # the few keys of the log: so what matches and what does not are two joins, and the rows stay put.
    matched = logged.join(side, [logged[f"__l_{k}"] == side[f"__f_{k}"] for k in first_keys[0]])
    met = side.select(*[F.col(f"__f_{k}").alias(f"__m_{k}") for k in first_keys[0]]).distinct()
    alone = logged.join(met, [logged[f"__l_{k}"] == met[f"__m_{k}"] for k in first_keys[0]], "left_anti")
    out = matched.unionByName(alone, allowMissingColumns=True)
    first = previous = name
    for name, table in tables[1:]:
        side = prefixed(table, f"{name}_").withColumns(
            {f"{name}__{k}": try_long(f"{name}_{c}") for k, c in link_keys.items()}
        )
        cond = [out[f"{first}__{k}"] == side[f"{name}__{k}"] for k in link_keys]
        if previous != first:
            cond.append(out[f"{previous}__{next(iter(link_keys))}"].isNotNull())
        # Merged at every size: a wide side read from narrow files looks small enough to broadcast when it is not.
        out = out.join(side.hint("merge"), cond, "left")
        previous = name
    kept = link_columns(tables, link_keys) if keep_links else []
    helpers = [f"{n}__{k}" for n, _ in tables for k in link_keys]
    firsts = [f"__{s}_{k}" for s in "lf" for k in first_keys[0]]
    return out.drop(*[c for c in [*helpers, *firsts] if c not in kept])


def link_columns(tables: list[tuple[str, DataFrame]], link_keys: dict[str, str]) -> list[str]:
    """The columns by which :func:`combine_chain` deals its rows out."""
    return [f"{tables[0][0]}__{k}" for k in link_keys]


def map_names(df: DataFrame, mapping: DataFrame, source: str, map_from: str, map_to: str, out: str) -> DataFrame:
    """Inner join through a name dictionary; names it lacks drop out."""
    side = mapping.select(F.col(map_from).alias("__from"), F.col(map_to).alias(out))
    return df.join(side, df[source] == side["__from"], "inner").drop("__from")


def with_opponent(
    df: DataFrame, group: str, member: str, cols: dict[str, str], null_group: bool = False
) -> DataFrame:
    """Attach columns of the other members of the group (``{input: output}``).

    A group of two gives each row its opponent; one-sided groups drop out and larger
    ones repeat rows, as the equality-plus-inequality self join means.
    """
    other = df.select(
        F.col(group).alias("__g"), F.col(member).alias("__m"),
        *[F.col(c).alias(out) for c, out in cols.items()],
    )
    cond = (df[group] == other["__g"]) & (df[member] != other["__m"])
    return df.join(other, cond, "inner").drop("__g", "__m")


def attach(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Bring the columns of ``other`` to ``df`` on equal keys."""
    return df.join(other, keys, how)


def attach_context(
    df: DataFrame, context: DataFrame, on: dict[str, str], text_ids: list[str], cols: list[str]
) -> DataFrame:
    """Left join where ids are bigint on one side and text on the other.

    ``on`` maps a column of ``df`` to one of ``context``; those in ``text_ids`` are
    read as bigint on the context side.
    """
    side = context.select(
        *[
            (try_long(c) if c in text_ids else F.col(c)).alias(f"__k_{c}")
            for c in on.values()
        ],
        *[F.col(c).alias(f"__v_{c}") for c in cols],
    )
    cond = [df[a] == side[f"__k_{b}"] for a, b in on.items()]
    joined = df.join(side, cond, "left").drop(*[f"__k_{b}" for b in on.values()])
    return joined.withColumnsRenamed({f"__v_{c}": c for c in cols})


def full_outer_merge(dfs: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of all frames; key columns hold whichever side has them."""
    return reduce(lambda a, b: a.join(b, keys, "full"), dfs)


def rows_for_keys(df: DataFrame, c: str, keys: DataFrame | list) -> DataFrame:
    """Rows for a list of keys; a key listed twice returns its rows twice.

    A Python list is a literal the caller typed and becomes a local relation; anything
    larger comes as a DataFrame whose first column holds the keys.
    """
    if not isinstance(keys, DataFrame):
        dtype = df.schema[c].dataType.simpleString()
        keys = df.sparkSession.createDataFrame([(k,) for k in keys], f"__key {dtype}")
    side = keys.select(F.col(keys.columns[0]).alias("__key"))
    return df.join(side, df[c] == side["__key"], "inner").drop("__key")


def filter_to_keys(df: DataFrame, c: str, ids: list | DataFrame) -> DataFrame:
    """Rows whose id, read as text, is in the list (a semi join for a DataFrame)."""
    if isinstance(ids, DataFrame):
        side = ids.select(F.col(ids.columns[0]).cast("string").alias("__id"))
        return df.join(side, df[c].cast("string") == side["__id"], "left_semi")
    return df.filter(F.col(c).cast("string").isin([str(i) for i in ids]))


def current_season_only(df: DataFrame, season: DataFrame, c: str = "seasonId") -> DataFrame:
    """Rows of the one season in ``season`` (a one-row frame), as a scalar subquery."""
    return df.filter(F.col(c) == season.select(season.columns[0]).scalar())
