"""Safe typing of all-text raw columns, null handling and small predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: str | Column) -> Column:
    """Text to double, NULL where the text is no number."""
    return col_of(c).try_cast("double")


def try_long(c: str | Column) -> Column:
    """Text to bigint, NULL where the text is no number.

    Ids that passed through a float column arrive as ``'22024.0'``; those are
    rounded through DECIMAL, which keeps every digit of a 10-digit id.
    """
    c = col_of(c)
    return F.coalesce(
        c.try_cast("bigint"),
        F.round(c.try_cast("decimal(38,10)"), 0).try_cast("bigint"),
    )


def try_date(c: str | Column) -> Column:
    """Text to date. A bare year or year-month is not a date here."""
    c = col_of(c)
    return F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), c.try_cast("date"))


def first_of(*cols: str | Column) -> Column:
    """First non-null value."""
    return F.coalesce(*[col_of(c) for c in cols])


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col_of(c), F.lit(0.0))


def null_if_zero(c: str | Column) -> Column:
    return F.nullif(col_of(c), F.lit(0.0))


def null_if_zero_den(value: str | Column, den: str | Column) -> Column:
    """A ratio with nothing attempted is unknown; an unknown denominator keeps the ratio."""
    return F.when(col_of(den) == 0, None).otherwise(col_of(value))


def round_to(c: str | Column, n: int) -> Column:
    return F.round(col_of(c).cast("double"), n)


def eq_intish(c: str | Column, value: int | str) -> Column:
    """Equality for keys stored as number in one table and as text in another."""
    return col_of(c).cast("string") == F.lit(str(value))


def at_least(c: str | Column, threshold: float, missing: float = -999.0) -> Column:
    """``c >= threshold`` where a missing or unreadable value counts as ``missing``."""
    return F.coalesce(try_double(c), F.lit(float(missing))) >= F.lit(float(threshold))


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def to_numeric(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    """Coerce the listed columns that exist; unreadable values become NULL."""
    cast = try_long if to == "bigint" else try_double
    present = {c.lower(): c for c in df.columns}
    return df.withColumns(
        {present[c.lower()]: cast(present[c.lower()]) for c in cols if c.lower() in present}
    )


def first_existing(df: DataFrame, names: list[str]) -> str | None:
    """First candidate the frame has (names compare without case)."""
    present = {c.lower(): c for c in df.columns}
    return next((present[n.lower()] for n in names if n and n.lower() in present), None)


def filter_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where every listed column is known."""
    return df.filter(~any_null(cols))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_columns(df: DataFrame, keys: list[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key columns {missing}; have {df.columns}")


def all_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
