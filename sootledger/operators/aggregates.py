"""Aggregations. Every grouped sum combines map-side before its shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger.session import cut_lineage
from sootledger.functions.numbers import to_number, to_tonnes


def count_distinct(df: DataFrame, key: str, alias: str, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct(key) if approx else F.count_distinct(F.col(key))
    return df.agg(count.alias(alias))


def count_rows(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.count(column).alias(alias))


def tonnes(impact: str = "IMPACT") -> Column:
    """Kilograms summed to tonnes; NULL when there is no row."""
    return to_tonnes(F.sum(impact))


def total_tonnes(df: DataFrame, alias: str, impact: str = "IMPACT") -> DataFrame:
    return df.agg(tonnes(impact).alias(alias))


def tonnes_by(
    df: DataFrame, keys: Sequence[str | Column], alias: str, impact: str = "IMPACT"
) -> DataFrame:
    return df.groupBy(*keys).agg(tonnes(impact).alias(alias))


def group_total(df: DataFrame, key: str, value: str = "tCO2e") -> DataFrame:
    """Grouped sum that keeps the NULL key and tolerates absent columns (empty result)."""
    if key not in df.columns or value not in df.columns:
        schema = T.StructType([T.StructField(key, T.StringType()),
                               T.StructField(value, T.DoubleType())])
        return df.sparkSession.createDataFrame([], schema)
    return df.groupBy(key).agg(F.sum(value).alias(value))


def sum_or_zero(value: str | Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def matrix(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Cross table of sums, 0 where empty; rows and columns with a NULL key are left out.

    The input is summed once; the column values are read from the stored sums. Those listed in ``columns``
    come first and always, all others follow in order: nothing is lost.
    """
    filled = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    listed = list(columns or [])
    sums = cut_lineage(filled.groupBy(row, column).agg(F.sum(value).alias(value)))
    found = sorted(r[0] for r in sums.select(column).distinct().collect())
    pivoted = sums.groupBy(row).pivot(column, listed + [c for c in found if c not in listed])
    return pivoted.agg(F.sum(value)).na.fill(0.0)


def day_bounds(
    frames: Sequence[tuple[DataFrame, str]], default: tuple[dt.date, dt.date]
) -> DataFrame:
    """First and last day over several frames, with defaults when there is none."""
    days = reduce(
        DataFrame.unionByName,
        [f.agg(F.min(c).alias("lo"), F.max(c).alias("hi")) for f, c in frames],
    )
    return days.agg(
        F.coalesce(F.min("lo"), F.lit(default[0])).alias("date_min"),
        F.coalesce(F.max("hi"), F.lit(default[1])).alias("date_max"),
    )


def value_bounds(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def missing_percent(df: DataFrame, column: str, alert_above: float) -> DataFrame:
    """Share of rows without a number, 0 for no rows, and whether it is alarming."""
    lacking = F.count_if(to_number(column).isNull())
    percent = F.coalesce(F.try_divide(F.lit(100.0) * lacking, F.count(F.lit(1))), F.lit(0.0))
    return df.agg(percent.alias("missing_pct")).withColumn(
        "alert", F.col("missing_pct") > F.lit(alert_above)
    )


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).na.drop().distinct().orderBy(column)


def load_counts(df: DataFrame, keys: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """Rows and missing values per group in one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in nullable],
    )
