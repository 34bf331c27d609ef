"""Ordered series per key: sequence numbers, running, expanding, rolling and neighbour values.

A series is all rows that share ``keys``, ordered by ``order`` (date first, a unique
id last so that ties cannot reorder). Two ways to compute over it:

* ``block=None``: one window per series. One shuffle on the keys, one sort, any number
  of columns. Right where the grain bounds a series, e.g. one row per player and day
  within one season.
* ``block=<column>``: for series of unknown length, where one key may hold a third of
  all rows. ``block`` must be a non-decreasing function of the leading order column
  (``time_block`` builds one). Windows then run per (keys, block), so a hot series
  spreads over as many tasks as it has blocks. What crosses a block border is carried
  by a table with one row per (keys, block), built with map-side partial aggregation:
  running sums as an exclusive prefix, row frames as the last few rows before the block.
  Results are exact, not approximate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from statmart.functions.casts import col_of

from .joins import join_null_safe

BLOCK = "__block"
ALL_BEFORE = (W.unboundedPreceding, W.currentRow)
PRIOR_ONLY = (W.unboundedPreceding, -1)


def time_block(c: str | Column, unit: str = "week") -> Column:
    """Block column for a date or timestamp: its calendar unit (hour, day, week, month)."""
    return F.date_trunc(unit, col_of(c))


def _ordering(order: list[str | Column]) -> list[Column]:
    return [col_of(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def series_window(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*_ordering(order))


# -- running sums -------------------------------------------------------------

def running(
    df: DataFrame,
    sums: dict[str, Column],
    keys: list[str],
    order: list[str | Column],
    block: Column | None = None,
    prior_only: bool = False,
) -> DataFrame:
    """Running sum of each expression, NULL until the first known value.

    ``prior_only`` leaves the current row out.
    """
    frame = PRIOR_ONLY if prior_only else ALL_BEFORE
    if block is None:
        w = series_window(keys, order).rowsBetween(*frame)
        return df.withColumns({out: F.sum(e).over(w) for out, e in sums.items()})

    outs = list(sums)
    marked = df.withColumn(BLOCK, block)
    totals = marked.groupBy(*keys, BLOCK).agg(
        *[F.sum(e).alias(f"__t{i}") for i, e in enumerate(sums.values())]
    )
    before = series_window(keys, [BLOCK]).rowsBetween(*PRIOR_ONLY)
    carry = totals.select(
        *keys, BLOCK, *[F.sum(f"__t{i}").over(before).alias(f"__c{i}") for i in range(len(outs))]
    )
    local = series_window([*keys, BLOCK], order).rowsBetween(*frame)
    inside = marked.withColumns({out: F.sum(e).over(local) for out, e in sums.items()})
    joined = join_null_safe(inside, carry, [*keys, BLOCK])
    whole = {
        out: F.coalesce(F.col(out) + F.col(f"__c{i}"), F.col(out), F.col(f"__c{i}"))
        for i, out in enumerate(outs)
    }
    return joined.withColumns(whole).select(*df.columns, *[o for o in outs if o not in df.columns])


def sequence_number(
    df: DataFrame, out: str, keys: list[str], order: list[str | Column], block: Column | None = None
) -> DataFrame:
    """1, 2, 3, ... along each series."""
    if block is None:
        return df.withColumn(out, F.row_number().over(series_window(keys, order)).cast("bigint"))
    return running(df, {out: F.lit(1).cast("bigint")}, keys, order, block)


def running_count(
    df: DataFrame,
    conds: dict[str, Column],
    keys: list[str],
    order: list[str | Column],
    block: Column | None = None,
    prior_only: bool = False,
) -> DataFrame:
    """How many rows so far met each condition (NULL on the first row if ``prior_only``)."""
    ones = {o: F.when(c, 1).otherwise(0).cast("bigint") for o, c in conds.items()}
    return running(df, ones, keys, order, block, prior_only)


def expanding_avg(
    df: DataFrame,
    cols: dict[str, str | Column],
    keys: list[str],
    order: list[str | Column],
    cond: Column | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Mean of everything up to and including the row; ``{output: input}``.

    With ``cond`` only matching rows count; rows that do not match still carry the
    mean so far.
    """
    inputs = {
        out: (col_of(c) if cond is None else F.when(cond, col_of(c))) for out, c in cols.items()
    }
    if block is None:
        w = series_window(keys, order).rowsBetween(*ALL_BEFORE)
        return df.withColumns({out: F.avg(c).over(w) for out, c in inputs.items()})
    parts: dict[str, Column] = {}
    for i, c in enumerate(inputs.values()):
        parts[f"__s{i}"] = c.cast("double")
        parts[f"__n{i}"] = F.when(c.isNotNull(), 1).otherwise(0).cast("bigint")
    summed = running(df, parts, keys, order, block)
    means = {
        out: F.col(f"__s{i}") / F.nullif(F.col(f"__n{i}"), F.lit(0)) for i, out in enumerate(inputs)
    }
    return summed.withColumns(means).drop(*parts)


# -- bounded row frames: rolling, lag, lead -----------------------------------

Build = Callable[[WindowSpec], dict[str, Column]]


def over_rows(
    df: DataFrame,
    build: Build | list[Build],
    keys: list[str],
    order: list[str | Column],
    back: int = 0,
    ahead: int = 0,
    block: Column | None = None,
) -> DataFrame:
    """Columns over frames that reach at most ``back`` rows back and ``ahead`` rows on.

    ``build`` gets the ordered window and returns the new columns; several builders share
    one layout. With ``block`` the last ``back`` rows before a block and the first
    ``ahead`` rows after it are copied into it, the windows run inside, and the copies are
    dropped again. ``order`` must then be plain ascending column names.
    """
    builders = build if isinstance(build, list) else [build]

    def built(w: WindowSpec) -> dict[str, Column]:
        return {out: c for b in builders for out, c in b(w).items()}

    if block is None:
        return df.withColumns(built(series_window(keys, order)))

    names = [o for o in order if isinstance(o, str)]
    if len(names) != len(order):
        raise ValueError("a blocked series needs plain column names as order")
    marked = df.withColumn(BLOCK, block)
    payload = F.struct(*[F.col(c) for c in marked.columns if c not in (*keys, BLOCK)])
    pieces = [marked.withColumn("__copy", F.lit(False))]
    if back:
        pieces.append(_border_rows(marked, payload, keys, names, back, forward=False))
    if ahead:
        pieces.append(_border_rows(marked, payload, keys, names, ahead, forward=True))
    union = reduce(DataFrame.unionByName, pieces)
    inside = union.withColumns(built(series_window([*keys, BLOCK], order)))
    return inside.filter(~F.col("__copy")).drop(BLOCK, "__copy")


def _border_rows(
    marked: DataFrame, payload: Column, keys: list[str], order: list[str], n: int, forward: bool
) -> DataFrame:
    """Copies of the ``n`` rows next to each block, labelled with that block.

    Each block keeps only its outermost ``n`` rows (row number with a limit, so map
    tasks pass on at most ``n`` rows per block) and learns from the sizes of the ``n``
    blocks beyond it which of them still need its rows: a block needs a row if fewer than
    ``n`` rows stand between. So a block gets ``n`` copies at most, and rows never gather.
    """
    side = [F.col(o).asc_nulls_last() if forward else F.col(o).desc_nulls_first() for o in order]
    edge = (
        marked.withColumn("__rn", F.row_number().over(W.partitionBy(*keys, BLOCK).orderBy(*side)))
        .filter(F.col("__rn") <= n)
        .groupBy(*keys, BLOCK)
        .agg(F.collect_list(F.struct(F.col("__rn"), payload.alias("row"))).alias("__edge"))
    )
    beyond = W.partitionBy(*keys).orderBy(F.col(BLOCK).desc_nulls_first() if forward else F.col(BLOCK).asc_nulls_last())
    sizes = F.collect_list(F.struct(F.col(BLOCK).alias("b"), F.size("__edge").alias("size"))).over(beyond.rowsBetween(1, n))
    between = lambda i: F.aggregate(F.slice("__sizes", F.lit(1), i), F.lit(0), lambda total, x: total + x["size"])
    targets = F.transform("__sizes", lambda x, i: F.struct(x["b"].alias("b"), between(i).alias("between")))
    wanted = edge.withColumn("__sizes", sizes).select(*keys, "__edge", F.explode(F.filter(targets, lambda t: t["between"] < n)).alias("__t"))
    rows = F.filter("__edge", lambda r: r["__rn"] + F.col("__t.between") <= n)
    return wanted.select(*keys, F.col("__t.b").alias(BLOCK), F.explode(rows).alias("__r"), F.lit(True).alias("__copy")).select(
        *keys, BLOCK, "__r.row.*", "__copy"
    )


def mean_of_last(cols: dict[str, str | Column], n: int, count_as: str | None = None) -> Build:
    """Builder: mean over the last ``n`` rows; ``count_as`` adds how many rows the frame held."""

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(n - 1), 0)
        out = {o: F.avg(col_of(c)).over(frame) for o, c in cols.items()}
        if count_as:
            out[count_as] = F.count(F.lit(1)).over(frame)
        return out

    return build


def rate_of_last(out: str, cond: Column, n: int, digits: int = 3) -> Build:
    """Builder: share of the last ``n`` rows (or all so far, if fewer) that meet ``cond``."""

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(n - 1), 0)
        hits = F.sum(F.when(cond, 1).otherwise(0)).over(frame).cast("double")
        # Inside the frame the row count is min(n, position in the series).
        return {out: F.round(hits / F.least(F.lit(n), F.count(F.lit(1)).over(frame)), digits)}

    return build


def rolling_avg(
    df: DataFrame,
    cols: dict[str, str | Column],
    n: int,
    keys: list[str],
    order: list[str | Column],
    count_as: str | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Mean over the last ``n`` rows; ``count_as`` adds how many rows the frame held."""
    return over_rows(df, mean_of_last(cols, n, count_as), keys, order, back=n - 1, block=block)


def require_full(df: DataFrame, count_col: str, n: int) -> DataFrame:
    """Keep rows whose frame held at least ``n`` rows."""
    return df.filter(F.col(count_col) >= n)


def rolling_rate(
    df: DataFrame,
    out: str,
    cond: Column,
    n: int,
    keys: list[str],
    order: list[str | Column],
    digits: int = 3,
    block: Column | None = None,
) -> DataFrame:
    """Share of the last ``n`` rows (or all so far, if fewer) that meet ``cond``."""
    return over_rows(df, rate_of_last(out, cond, n, digits), keys, order, back=n - 1, block=block)


def lag_of(out: str, c: str) -> Build:
    return lambda w: {out: F.lag(c).over(w)}


def lead_of(out: str, c: str) -> Build:
    return lambda w: {out: F.lead(c).over(w)}


def gap_days(out: str, date: str) -> Build:
    """Builder: days since the previous row, NULL on the first."""
    return lambda w: {out: F.datediff(F.col(date), F.lag(date).over(w)).cast("bigint")}


def previous_value(
    df: DataFrame, out: str, c: str, keys: list[str], order: list[str | Column],
    block: Column | None = None,
) -> DataFrame:
    return over_rows(df, lag_of(out, c), keys, order, back=1, block=block)


def next_id(
    df: DataFrame, out: str, c: str, keys: list[str], order: list[str | Column],
    block: Column | None = None,
) -> DataFrame:
    """Id of the following row of the series, NULL on the last."""
    return over_rows(df, lead_of(out, c), keys, order, ahead=1, block=block)


def days_since_prev(
    df: DataFrame, out: str, date: str, keys: list[str], order: list[str | Column],
    block: Column | None = None,
) -> DataFrame:
    """Days since the previous row, NULL on the first."""
    return over_rows(df, gap_days(out, date), keys, order, back=1, block=block)


def is_back_to_back(days_col: str) -> Column:
    return F.when(F.col(days_col) == 1, 1).otherwise(0)


# -- calendar frames ----------------------------------------------------------

def count_in_trailing_days(
    df: DataFrame, outs: dict[str, int], keys: list[str], date: str, pre_aggregate: bool = False
) -> DataFrame:
    """Rows of the series dated within the last ``n`` days, both ends included.

    Rows without a key or date count 0. ``pre_aggregate`` first reduces to one row per
    key and day with map-side combine, so a series costs its days, not its rows; use
    it where many rows share a day.
    """
    known = ~reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*keys, date]])
    day = F.unix_date(F.col(date).cast("date"))

    def frame(n: int) -> WindowSpec:
        return W.partitionBy(*keys).orderBy(day).rangeBetween(-n, 0)

    if not pre_aggregate:
        return df.withColumns(
            {
                out: F.when(known, F.count(F.lit(1)).over(frame(n))).otherwise(0).cast("bigint")
                for out, n in outs.items()
            }
        )
    daily = df.filter(known).groupBy(*keys, date).agg(F.count(F.lit(1)).alias("__n"))
    trailing = daily.select(
        *keys, date, *[F.sum("__n").over(frame(n)).alias(out) for out, n in outs.items()]
    )
    return (
        df.join(trailing, [*keys, date], "left")
        .withColumns({out: F.coalesce(F.col(out), F.lit(0)).cast("bigint") for out in outs})
        .select(*df.columns, *outs)
    )


# -- last rows ----------------------------------------------------------------

def last_active_flag(
    df: DataFrame, out: str, active: Column, keys: list[str], order: list[str], whole: bool = True
) -> DataFrame:
    """1 on the latest row of the series that is active, 0 elsewhere.

    Compares each row with the greatest (order) among active rows. ``whole=True`` takes
    it from a window over the series; ``whole=False`` from a grouped maximum joined
    back, which combines on the map side and suits series of unknown length.
    """
    stamp = F.struct(*[F.col(o) for o in order])
    if whole:
        top = F.max(F.when(active, stamp)).over(W.partitionBy(*keys))
        return df.withColumn(out, F.when(active & (stamp == top), 1).otherwise(0))
    latest = df.filter(active).groupBy(*keys).agg(F.max(stamp).alias("__top"))
    return (
        join_null_safe(df, latest, keys)
        .withColumn(out, F.when(active & (stamp == F.col("__top")), 1).otherwise(0))
        .select(*df.columns, out)
    )


def is_last(df: DataFrame, out: str, c: str, keys: list[str], whole: bool = True) -> DataFrame:
    """1 on every row that carries the greatest value of ``c`` in its group.

    ``whole`` as in :func:`last_active_flag`.
    """
    if whole:
        top = F.max(c).over(W.partitionBy(*keys))
        return df.withColumn(out, F.when(F.col(c) == top, 1).otherwise(0))
    tops = df.groupBy(*keys).agg(F.max(c).alias("__top"))
    flagged = join_null_safe(df, tops, keys).withColumn(out, F.when(F.col(c) == F.col("__top"), 1).otherwise(0))
    return flagged.select(*df.columns, out)


def latest_per(
    df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None, k: int = 1
) -> DataFrame:
    """The latest ``k`` rows per key: greatest ``order`` first, NULLs last, then ``ties`` ascending.

    Spark turns the row-number filter into a group limit, so each map task ships at
    most ``k`` rows per key, however many rows the key has.
    """
    ordering = [F.col(o).desc_nulls_last() for o in order]
    ordering += [F.col(t).asc_nulls_last() for t in ties or []]
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("__rn", rn).filter(F.col("__rn") <= k).drop("__rn")
