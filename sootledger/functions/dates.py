"""Day-grain date functions. Days are DateType, so no time zone can move them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger import domain


def to_day(c: Column | str) -> Column:
    """Timestamp text to its (UTC session) day; text that is no timestamp gives NULL."""
    return F.to_date(F.try_to_timestamp(F.col(c) if isinstance(c, str) else c))


def year_month(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")


def years_between(day: Column | str, birth: Column | str) -> Column:
    return F.datediff(day, birth) / F.lit(365.25)


def day_label(c: Column | str) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(domain.UNKNOWN_MARK))


def add_days(c: Column | str, n: int) -> Column:
    return F.date_add(c, n)


def day_of_file(name: Column | str) -> Column:
    """The yyyyMMdd day inside a file name, NULL when the name has none."""
    digits = F.regexp_extract(name, r"(\d{8})", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")))


def file_name_of(prefix: str, day: Column | str) -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(day, "yyyyMMdd"), F.lit(".txt"))


def day_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of an inclusive range, as column ``day``."""
    span = (end - start).days + 1
    return spark.range(max(span, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day")
    )
