"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column some frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged(df: DataFrame, value: str, column: str = "source") -> DataFrame:
    return df.withColumn(column, F.lit(value))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_places(trips: DataFrame) -> DataFrame:
    """Every place that is a start or an end of a trip, once, in order."""
    starts = trips.select(F.col("VILLE_DEPART").alias("VILLE"), F.col("PAYS_DEPART").alias("PAYS"))
    ends = trips.select("VILLE_DESTINATION", "PAYS_DESTINATION").toDF("VILLE", "PAYS")
    return starts.union(ends).distinct().orderBy("VILLE", "PAYS")
