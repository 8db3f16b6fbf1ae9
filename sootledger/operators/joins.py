"""Joins.

Broadcast hints appear only on tables whose row count is fixed by this library
(bands, display orders). Everything read from storage is left to Catalyst: it
broadcasts a side whose measured size is under the session threshold and
otherwise shuffles, where adaptive execution splits a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sootledger.functions.text import site_of
from sootledger.operators.ranking import last_per_key


def lookup(df: DataFrame, reference: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Left equi-join to a reference whose keys are unique; NULL never matches."""
    return df.join(reference, on=[on] if isinstance(on, str) else list(on), how="left")


def star(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Fact to dimension; columns of the dimension that the fact already has are dropped."""
    extra = [c for c in dim.columns if c == key or c not in fact.columns]
    return fact.join(dim.select(*extra), on=key, how=how)


def semi_in(df: DataFrame, value: Column, values: DataFrame) -> DataFrame:
    """``value IN (subquery)`` over a one-column frame, as a semi join."""
    listed = values.toDF("_listed")
    return df.withColumn("_probe", value).join(
        listed, F.col("_probe") == F.col("_listed"), "left_semi"
    ).drop("_probe")


def unseen(df: DataFrame, known: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is not among the known keys.

    Known keys are made distinct first: that pre-aggregates a hot key map-side
    and its shuffle already has the partitioning the join needs.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(known.select(*keys).distinct(), on=keys, how="left_anti")


def band_lookup(df: DataFrame, bands: DataFrame, code: str, value: str) -> DataFrame:
    """Left range join: equal code and value inside the band; open bounds are NULL.

    Catalyst chooses how the bands, few by construction, meet the rows.
    """
    v = F.col(value)
    low = F.col("LO").isNull() | (v > F.col("LO")) | (F.col("LO_IN") & (v == F.col("LO")))
    high = F.col("HI").isNull() | (v < F.col("HI")) | (F.col("HI_IN") & (v == F.col("HI")))
    side = bands.withColumnRenamed("CODE", "_band_code")
    inside = (F.col(code) == F.col("_band_code")) & v.isNotNull() & low & high
    return df.join(side, inside, "left").drop("_band_code")


def with_both_ends(
    pairs: DataFrame, coordinates: DataFrame, ends: Sequence[Sequence[str]], how: str = "inner"
) -> DataFrame:
    """Attach the coordinates of both places of a pair as LAT_1, LON_1, LAT_2, LON_2."""
    for i, (city, country) in enumerate(ends, start=1):
        place = coordinates.select(
            F.col("VILLE").alias(city),
            F.col("PAYS").alias(country),
            F.col("LAT").alias(f"LAT_{i}"),
            F.col("LON").alias(f"LON_{i}"),
        )
        pairs = pairs.join(place, on=[city, country], how=how)
    return pairs


def lookup_or_compute(
    df: DataFrame, reference: DataFrame, on: Sequence[str], value: str, compute
) -> tuple[DataFrame, DataFrame]:
    """Look a value up; compute it once per distinct key that lacks one.

    ``compute`` maps a frame of distinct keys to the same frame plus ``value``.
    Returns the enriched frame and the new reference rows to append.
    """
    known = reference.filter(F.col(value).isNotNull())
    keys = df.select(*on).na.drop(how="any").distinct()
    missing = keys.join(known.select(*on), on=list(on), how="left_anti")
    added = compute(missing).filter(F.col(value).isNotNull()).select(*on, value)
    complete = known.select(*on, value).unionByName(added)
    return lookup(df, complete, on), added


def append_reference(reference: DataFrame, added: DataFrame, on: Sequence[str]) -> DataFrame:
    """Reference plus new rows; a key given twice keeps the added row."""
    both = reference.withColumn("_round", F.lit(0)).unionByName(
        added.withColumn("_round", F.lit(1))
    )
    return last_per_key(both, on, ["_round"]).drop("_round")


def outer_add(frames: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Sum of grouped results where a side that lacks a key counts as 0.

    Union and one aggregation: a single shuffle of partial sums, NULL keys kept.
    """
    stacked = reduce(DataFrame.unionByName, [f.select(*keys, value) for f in frames])
    return stacked.groupBy(*keys).agg(F.sum(value).alias(value))


def outer_add_join(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """The same result as ``outer_add`` by a null-safe full outer join of two sums."""
    a = left.select(F.col(key).alias("_ka"), F.col(value).alias("_va"), F.lit(1).alias("_a"))
    b = right.select(F.col(key).alias("_kb"), F.col(value).alias("_vb"))
    joined = a.join(b, F.col("_ka").eqNullSafe(F.col("_kb")), "full_outer")
    return joined.select(
        F.when(F.col("_a").isNotNull(), F.col("_ka")).otherwise(F.col("_kb")).alias(key),
        (F.coalesce("_va", F.lit(0.0)) + F.coalesce("_vb", F.lit(0.0))).alias(value),
    )


def reconcile_site(df: DataFrame, candidates: Sequence[str] = ()) -> DataFrame:
    """One ID_SITE: the column itself, then other candidates, then the employee id."""
    sources = [F.col(c) for c in ("ID_SITE", *candidates) if c in df.columns]
    if not sources and "ID_PERSONNEL" in df.columns:
        sources = [site_of("ID_PERSONNEL")]
    if not sources:
        return df
    return df.withColumn("ID_SITE", F.coalesce(*sources)).drop(*candidates)
