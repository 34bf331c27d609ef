"""Carry states: what a series has to remember of its past, so that new days need only their own rows.

A state is one row per series at a day's border: running sums, how many rows there were, the last
few rows in full, and where the last active row stands. New rows extend it; expanding means and
rolling frames over them come from the rows and the state before them, never from older rows. A
state as of every day of a range takes one aggregation of that range's rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from statmart.functions.casts import col_of

from .joins import join_null_safe
from .series import series_window

LAST, SEEN, ACTIVE = "last_rows", "rows_seen", "last_active"


@dataclass(frozen=True)
class Memory:
    """What is remembered of each series.

    ``keys`` name a series and ``order`` its order, the day first and a unique id last. ``means`` are
    the expressions whose running sums and counts are kept, ``kept`` the columns of the last ``n``
    rows, ``active`` the rows of which the last one's place is kept.
    """

    keys: list[str]
    order: list[str]
    means: dict[str, Column] = field(default_factory=dict)
    kept: list[str] = field(default_factory=list)
    n: int = 0
    active: Column | None = None

    @property
    def day(self) -> str:
        return self.order[0]

    def sums(self) -> dict[str, Column]:
        """Running sums by name: a sum and a count for each mean."""
        out = {}
        for name, c in self.means.items():
            out[f"sum_{name}"] = F.coalesce(c.cast("double"), F.lit(0.0))
            out[f"n_{name}"] = c.isNotNull().cast("bigint")
        return out

    def row(self) -> Column:
        """A kept row; it sorts by the series' order."""
        return F.struct(*[F.col(c) for c in dict.fromkeys([*self.order, *self.kept])])

    def stamp(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])


def _deltas(rows: DataFrame, m: Memory) -> DataFrame:
    """One row per series and day: what the day adds. A day's kept rows are cut to ``n`` where they lie.

    With kept rows the series are dealt out once: numbering and summing a day, and the window over the
    days after it, find that layout in place.
    """
    aggs = [F.sum(c).alias(name) for name, c in m.sums().items()]
    aggs.append(F.count(F.lit(1)).alias(SEEN))
    if m.active is not None:
        aggs.append(F.max(F.when(m.active, m.stamp())).alias(ACTIVE))
    if m.n:
        place = W.partitionBy(*m.keys, m.day).orderBy(*[F.col(o).desc_nulls_first() for o in m.order])
        rows = rows.repartition(*m.keys).withColumn("__rn", F.row_number().over(place))
        aggs.append(F.sort_array(F.collect_list(F.when(F.col("__rn") <= m.n, m.row()))).alias(LAST))
    return rows.groupBy(*m.keys, m.day).agg(*aggs)


def states(rows: DataFrame, m: Memory, before: DataFrame | None = None) -> DataFrame:
    """The state of every series at the end of each day that has rows, :attr:`Memory.day` saying which.

    ``before`` is the state at the last border before ``rows`` (without it every series is new). A
    series without rows on a day passes on what it had. Rows without a day belong to no state.
    """
    rows = rows.filter(F.col(m.day).isNotNull())
    deltas = _deltas(rows, m)
    if before is not None:
        # The state before stands in front of its series as one more day without a date.
        deltas = deltas.unionByName(before.withColumn(m.day, F.lit(None).cast(rows.schema[m.day].dataType)))
    in_order = W.partitionBy(*m.keys).orderBy(F.col(m.day).asc_nulls_first())
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    cols = {c: F.sum(c).over(so_far) for c in [*m.sums(), SEEN]}
    if m.active is not None:
        cols[ACTIVE] = F.max(ACTIVE).over(so_far)
    if m.n:
        # Every day has a row, so the last n days hold the last n rows.
        near = F.flatten(F.collect_list(LAST).over(in_order.rowsBetween(-(m.n - 1) if m.n > 1 else 0, 0)))
        cols[LAST] = F.slice(near, F.greatest(F.size(near) - (m.n - 1), F.lit(1)), m.n)
    here = deltas.withColumns(cols).withColumns({"__until": F.lead(m.day).over(in_order), "__days": rows.select(F.collect_set(m.day)).scalar()})
    begun, open_ = F.col(m.day).isNull(), F.col("__until").isNull()
    valid = F.filter("__days", lambda d: (begun | (d >= F.col(m.day))) & (open_ | (d < F.col("__until"))))
    return here.withColumn(m.day, F.explode(valid)).drop("__until", "__days")


def carried_means(rows: DataFrame, m: Memory, before: DataFrame | None = None) -> DataFrame:
    """``rows`` with the expanding mean of each of ``m.means``, its past taken from the state."""
    sums = m.sums()
    w = series_window(m.keys, m.order).rowsBetween(W.unboundedPreceding, 0)
    out = rows.withColumns({f"__{name}": F.sum(c).over(w) for name, c in sums.items()})
    if before is not None:
        past = before.select(*m.keys, *[F.col(name).alias(f"__past_{name}") for name in sums])
        out = join_null_safe(out, past, m.keys)
        out = out.withColumns({f"__{name}": F.col(f"__{name}") + F.coalesce(f"__past_{name}", F.lit(0)) for name in sums})
    means = {name: F.col(f"__sum_{name}") / F.nullif(F.col(f"__n_{name}"), F.lit(0)) for name in m.means}
    return out.withColumns(means).select(*rows.columns, *m.means)


def carried_rolling(
    rows: DataFrame, m: Memory, cols: dict[str, str | Column], n: int, before: DataFrame | None = None, count_as: str | None = None
) -> DataFrame:
    """``rows`` with the mean over the last ``n`` rows of the series, earlier rows taken from the state.

    The state must keep ``n - 1`` rows and every column that ``cols`` reads.
    """
    frame = series_window(m.keys, m.order).rowsBetween(-(n - 1), 0)
    outs = {name: F.avg(col_of(c)).over(frame) for name, c in cols.items()}
    if count_as:
        outs[count_as] = F.count(F.lit(1)).over(frame)
    all_rows = rows.withColumn("__past", F.lit(False))
    if before is not None:
        if m.n < n - 1:
            raise ValueError(f"the state keeps {m.n} rows, a frame of {n} needs {n - 1}")
        past = before.select(*m.keys, F.explode(LAST).alias("__r")).select(*m.keys, "__r.*").withColumn("__past", F.lit(True))
        # Only series that have new rows.
        past = join_null_safe(past, rows.select(*m.keys).distinct(), m.keys, "left_semi")
        all_rows = all_rows.unionByName(past, allowMissingColumns=True)
    return all_rows.withColumns(outs).filter(~F.col("__past")).select(*rows.columns, *outs)


def with_last_flag(rows: DataFrame, state: DataFrame, m: Memory, out: str) -> DataFrame:
    """1 on the row that the state names as the last active one of its series, 0 elsewhere."""
    known = state.select(*m.keys, F.col(ACTIVE).alias("__active"))
    same = reduce(lambda a, b: a & b, [F.col(f"__active.{o}").eqNullSafe(F.col(o)) for o in m.order])
    flag = F.when(F.col("__active").isNotNull() & same, 1).otherwise(0)
    return join_null_safe(rows, known, m.keys).withColumn(out, flag).select(*rows.columns, out)
