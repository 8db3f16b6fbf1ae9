"""First / last per key, top-n and fixed orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_FAR = 2**31 - 1


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # row_number() = 1 plans a WindowGroupLimit before the shuffle: every map
    # task sends at most one row per key, so a hot key does not fill one task.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(
    df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column]
) -> DataFrame:
    return _one_per_key(df, _keys(keys), [_asc(c) for c in order])


def last_per_key(
    df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column]
) -> DataFrame:
    return _one_per_key(df, _keys(keys), [_desc(c) for c in order])


def _asc(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c.asc_nulls_last()


def _desc(c: str | Column) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c.desc_nulls_last()


def top_n(df: DataFrame, measure: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n largest; equal measures are ordered by the tie columns."""
    return df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in ties]).limit(n)


def order_rows(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column) if descending else F.asc_nulls_last(column))


def listed_rank(column: str, listed: Sequence[str]) -> Column:
    """Place in a list, NULL when not listed."""
    place = F.array_position(F.array(*[F.lit(v) for v in listed]), F.col(column))
    return F.nullif(place, F.lit(0).cast("long")).cast("int")


def order_by_list(df: DataFrame, column: str, listed: Sequence[str]) -> DataFrame:
    """Listed categories in list order, the others after them by name."""
    rank = F.coalesce(listed_rank(column, listed), F.lit(_FAR))
    return df.withColumn("_place", rank).orderBy("_place", F.asc_nulls_last(column)).drop("_place")


def reindex_to_list(
    df: DataFrame, column: str, listed: Sequence[str], value: str
) -> DataFrame:
    """Exactly the listed categories in list order, 0 where the data has none.

    A zero per listed category is added to the rows: one aggregation, no join.
    """
    names = F.explode(F.array(*[F.lit(v) for v in listed])).alias(column)
    zeros = df.sparkSession.range(0, 1, 1, 1).select(names).withColumn(value, F.lit(0.0))
    rows = df.filter(F.col(column).isin(*listed)).select(column, value)
    totals = zeros.unionByName(rows).groupBy(column).agg(F.sum(value).alias(value))
    return totals.orderBy(listed_rank(column, listed))
