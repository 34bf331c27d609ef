"""Calendar arithmetic: seasons, ISO weeks, day gaps and packed dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def season_label(d: str | Column, last_month: int = 7) -> Column:
    """``2025-26`` style label; months up to ``last_month`` belong to the season begun a year before."""
    d = col_of(d)
    start = F.year(d) - F.when(F.month(d) <= last_month, 1).otherwise(0)
    end = F.substring(F.lpad((start + 1).cast("string"), 4, "0"), 3, 2)
    return F.concat(start.cast("string"), F.lit("-"), end)


def iso_year_week(d: str | Column) -> Column:
    """ISO week-numbering year and week, e.g. ``2026-53`` for 2027-01-01."""
    d = col_of(d).cast("date")
    year = F.extract(F.lit("YEAROFWEEK"), d).cast("string")
    return F.concat(year, F.lit("-"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def week_start(d: str | Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", col_of(d)).cast("date")


def week_end(d: str | Column) -> Column:
    """Sunday of the week."""
    return F.date_add(week_start(d), 6)


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(col_of(end), col_of(start)).cast("bigint")


def date_from_int(c: str | Column) -> Column:
    """A ``yyyymmdd`` number or text as a date, NULL if it is none."""
    text = col_of(c).cast("string")
    parts = [F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)]
    return F.concat_ws("-", *parts).try_cast("date")


def day_number(c: str | Column) -> Column:
    """Days since 1970-01-01, for frames measured in days."""
    return F.unix_date(col_of(c).cast("date"))
