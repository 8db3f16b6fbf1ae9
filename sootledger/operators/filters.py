"""Predicates and filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sootledger.functions.text import has_text

Day = dt.date | str


def folded(df: DataFrame, column: str) -> Column:
    """Lower-case view of a column; the stored copy when the table has one.

    ``lower(c) = x`` never reaches the Parquet statistics, ``c_KEY = x`` does.
    """
    key = f"{column}_KEY"
    return F.col(key) if key in df.columns else F.lower(F.col(column))


def ci_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(folded(df, column) == value.lower())


def ci_in(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    return df.filter(folded(df, column).isin(*[v.lower() for v in values]))


def ci_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(folded(df, column).startswith(prefix.lower()))


def as_day(value: Day) -> Column:
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def between_days(df: DataFrame, column: str, start: Day, end: Day) -> DataFrame:
    """Both days included; the column is a DATE, so the last day is complete."""
    return df.filter(F.col(column).between(as_day(start), as_day(end)))


def filter_period(
    df: DataFrame, start: Day | None = None, end: Day | None = None, column: str = "DATE"
) -> DataFrame:
    """Optional inclusive bounds on a date or timestamp; no such column, no filter."""
    if column not in df.columns:
        return df
    if start:
        df = df.filter(F.col(column) >= as_day(start))
    if end:
        df = df.filter(F.col(column) < F.date_add(as_day(end), 1))
    return df


def filter_tab_period(
    df: DataFrame,
    overall: tuple[Day | None, Day | None] = (None, None),
    tab: tuple[Day | None, Day | None] = (None, None),
    column: str = "DATE",
) -> DataFrame:
    """The overall period, then the tab's own; a bound the tab lacks is the overall one."""
    df = filter_period(df, *overall, column=column)
    return filter_period(df, tab[0] or overall[0], tab[1] or overall[1], column=column)


def filter_equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Conjunction of equalities; None and absent columns filter nothing."""
    for column, value in wanted.items():
        if value and column in df.columns:
            df = df.filter(F.col(column) == value)
    return df


def only_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def only_filled(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose columns are neither NULL nor blank."""
    for column in columns:
        df = df.filter(has_text(column))
    return df
