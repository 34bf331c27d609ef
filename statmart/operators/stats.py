"""Z-scores, distributed ranks and category leaders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from statmart.functions.casts import any_null, col_of
from statmart.session import materialise

from .joins import join_null_safe


#: Groups whose statistics are sent to every task; more are joined by salted keys.
FEW_GROUPS = 10_000
SALTS = 32


def attach_group_rows(df: DataFrame, groups: DataFrame, keys: list[str], few: int = FEW_GROUPS) -> DataFrame:
    """Bring the one row that ``groups`` has per key to every row of ``df``; NULL keys are equal.

    Facts are never dealt out by the group key, which would send a hot group to one task. Up to
    ``few`` groups, counted by running the aggregation, are broadcast; beyond that each group's row
    is replicated and the facts meet one of its copies by a hash of their values.
    """
    rows = groups.limit(few + 1).toArrow()
    if rows.num_rows <= few:
        return join_null_safe(df, F.broadcast(df.sparkSession.createDataFrame(rows, groups.schema)), keys)
    salt = F.pmod(F.xxhash64(*[F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]), F.lit(SALTS)).cast("int")
    copies = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return join_null_safe(df.withColumn("__salt", salt), copies, [*keys, "__salt"]).drop("__salt")


def group_statistics(df: DataFrame, cols: list[str], partition: list[str]) -> DataFrame:
    """Mean ``__m{i}`` and sample deviation ``__d{i}`` of each column per group, combined on the map side."""
    return df.groupBy(*partition).agg(
        *[F.avg(c).alias(f"__m{i}") for i, c in enumerate(cols)], *[F.stddev_samp(c).alias(f"__d{i}") for i, c in enumerate(cols)]
    )


def zscores(df: DataFrame, cols: dict[str, str], partition: list[str], few: int = FEW_GROUPS) -> DataFrame:
    """``(x - mean) / sample deviation`` within each partition; ``{output: input}``.

    No spread (or a single row) gives NULL. A window would send each season whole to
    one task; here means and deviations come from a partial aggregation, one row per
    partition, which :func:`attach_group_rows` brings back.
    """
    stats = group_statistics(df, list(cols.values()), partition)
    scored = {
        out: (F.col(c) - F.col(f"__m{i}")) / F.nullif(F.col(f"__d{i}"), F.lit(0.0))
        for i, (out, c) in enumerate(cols.items())
    }
    return attach_group_rows(df, stats, partition, few).withColumns(scored).select(*df.columns, *cols)


def rank_desc(
    df: DataFrame, c: str, group: list[str] | None = None, rank: str | None = None, dense: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """RANK and/or DENSE_RANK by ``c`` descending; NULL values get no rank."""
    return rank_each(df, {c: (rank, dense)}, group, buckets)


def rank_each(
    df: DataFrame, columns: dict[str, tuple[str | None, str | None]], group: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """RANK and/or DENSE_RANK by each column descending, ``{column: (rank, dense rank)}``; NULL gets none.

    A global (or per-season) rank window is one task. Instead: count equal values of all
    columns in one pass (map-side combine folds any run of ties), deal the distinct values
    in order to ``buckets`` ranges whose borders Spark samples from the values themselves,
    rank inside each range, and add what the ranges above hold. However the values are
    spread, a range has its share; the only table ordered in one place has a row per range,
    column and group that meet. The dealt values are written once, as a second sampling
    could choose other borders. There are as many ranges as shuffle partitions, if not told
    otherwise. Columns of different types are compared as doubles.
    """
    group = list(group or [])
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = {df.schema[c].dataType for c in columns}
    value = {c: F.col(c) if len(kinds) == 1 else F.col(c).cast("double") for c in columns}
    each = F.array(*[F.struct(F.lit(i).alias("__c"), v.alias("__v")) for i, v in enumerate(value.values())])
    values = df.select(*group, F.inline(each)).filter("__v IS NOT NULL")
    counts = values.groupBy("__c", *group, "__v").agg(F.count(F.lit(1)).alias("__n"))
    dealt = counts.repartitionByRange(buckets, "__c", *group, F.col("__v").desc()).withColumn("__b", F.spark_partition_id())
    dealt = materialise(dealt, "ranked-values")
    place = ["__c", *group]
    ranges = dealt.groupBy(*place, "__b").agg(F.sum("__n").alias("__bn"), F.count(F.lit(1)).alias("__bd"))
    above = W.partitionBy(*place).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select(
        *place, "__b",
        F.coalesce(F.sum("__bn").over(above), F.lit(0)).alias("__on"), F.coalesce(F.sum("__bd").over(above), F.lit(0)).alias("__od"),
    )
    inside = W.partitionBy(*place, "__b").orderBy(F.col("__v").desc())
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = dealt.withColumns({"__ln": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__ld": F.row_number().over(inside)})
    ranks = join_null_safe(local, offsets, [*place, "__b"]).select(
        *place, "__v", (F.col("__on") + F.col("__ln") + 1).cast("bigint").alias("__rank"), (F.col("__od") + F.col("__ld")).cast("bigint").alias("__dense")
    )
    out = df
    for i, (c, (rank, dense)) in enumerate(columns.items()):
        outs = [F.col(source).alias(name) for source, name in (("__rank", rank), ("__dense", dense)) if name]
        side = ranks.filter(F.col("__c") == i).select(*group, "__v", *outs)
        marked = out.withColumn("__v", value[c])
        out = join_null_safe(marked, side, [*group, "__v"]).select(*out.columns, *[n for n in (rank, dense) if n])
    return out


def numbered(df: DataFrame, order: list[Column], out: str, buckets: int | None = None) -> DataFrame:
    """Number all rows from 1 in the given order, without gathering them in one task.

    Rows are dealt in order to ranges and written once; a range's numbers begin after
    what the ranges before it hold. Rows that tie are numbered in any order.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(buckets, *order).withColumn("__b", F.spark_partition_id()), "numbered")
    before = W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = offsets.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    place = F.row_number().over(W.partitionBy("__b").orderBy(*order))
    return dealt.withColumn("__p", place).join(offsets, "__b").withColumn(out, F.col("__o") + F.col("__p")).select(*df.columns, out)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order (each task keeps only ``n``)."""
    return df.orderBy(*order).limit(n)


def rank_top(df: DataFrame, c: str, n: int, out: str, ties: list[str]) -> DataFrame:
    """RANK by ``c`` descending for the top ``n`` rows only.

    Every row above a kept row is kept too, so ranking the ``n`` kept rows gives the
    rank over the whole table, and the window sees at most ``n`` rows.
    """
    order = [F.col(c).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    kept = top_n(df.filter(F.col(c).isNotNull()), order, n)
    return kept.withColumn(out, F.rank().over(W.orderBy(F.col(c).desc())).cast("bigint"))


def dense_index(df: DataFrame, out: str, c: str, group: list[str]) -> DataFrame:
    """Number the distinct values of ``c`` in each group from 1 and attach the number.

    The numbering window sees distinct values only (weeks of a season). Rows whose group
    or value is NULL drop out, as an inner join on them would have it.
    """
    known = df.filter(~any_null([*group, c]))
    distinct = known.select(*group, c).distinct()
    w = W.partitionBy(*group).orderBy(F.col(c).asc_nulls_last())
    return attach_group_rows(known, distinct.withColumn(out, F.dense_rank().over(w).cast("bigint")), [*group, c])


def leaders(
    df: DataFrame, categories: dict[str, str], group: list[str], ties: list[str], carry: list[str]
) -> DataFrame:
    """Best row per group for every category, ``{category: ranking column}``.

    One aggregation finds all leaders: each keeps the greatest (value, then smallest
    tie-break) with the carried columns. Result has one row per group and category.
    """
    ties_desc = [(-F.col(t)).alias(f"t{i}") for i, t in enumerate(ties)]
    aggs = []
    for i, c in enumerate(categories.values()):
        entry = F.struct(
            F.col(c).cast("double").alias("v"), *ties_desc,
            *[F.col(x).alias(f"c_{x}") for x in carry],
        )
        aggs.append(F.max(F.when(F.col(c).isNotNull(), entry)).alias(f"__l{i}"))
    best = df.groupBy(*group).agg(*aggs)
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("category"), F.lit(i).alias("pos"), F.col(f"__l{i}").alias("best"))
            for i, name in enumerate(categories)
        ]
    )
    return best.select(*group, F.explode(entries).alias("e")).select(
        *group, "e.category", "e.pos", *[F.col(f"e.best.c_{x}").alias(x) for x in carry]
    )


def scalar_max(df: DataFrame, c: str | Column, out: str) -> DataFrame:
    return df.agg(F.max(col_of(c)).alias(out))
