"""Incremental loading of dimensions and facts from a log of days.

A log is any frame with ``ingest_date`` and ``load_order`` (the place of a row
in its day). All days are handled at once; there is no loop over days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sootledger.operators.joins import unseen
from sootledger.operators.ranking import first_per_key, last_per_key

DAY, PLACE = "ingest_date", "load_order"


def dim_snapshot(log: DataFrame, pk: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, the last one ever sent."""
    return last_per_key(log.select(DAY, PLACE, *columns), pk, [DAY, PLACE])


def dim_delta(log: DataFrame, pk: str, columns: Sequence[str]) -> DataFrame:
    """Keys on the day they were first seen, with the last row of that day."""
    rows = log.select(DAY, PLACE, *columns)
    return first_per_key(rows, pk, [F.col(DAY), -F.col(PLACE)])


def dim_delta_of(
    some_days: DataFrame, known: DataFrame, pk: str, columns: Sequence[str]
) -> DataFrame:
    """``dim_delta`` restricted to some days, without ranking the whole history.

    ``known`` holds (key, ingest_date) of the deltas of all other days. A key is
    there once, not once per row ever sent. History is on the streamed side of a
    semi join with the keys of these days, so it is only scanned, not shuffled,
    while those keys are small enough to broadcast; what is left to compare has
    the size of these days.
    """
    fresh = dim_delta(some_days, pk, columns)
    asked = fresh.select(F.col(pk).alias("_asked"), F.col(DAY).alias("_asked_day"))
    seen_before = (F.col(pk) == F.col("_asked")) & (F.col(DAY) < F.col("_asked_day"))
    seen = known.select(pk, DAY).join(asked, seen_before, "left_semi")
    return unseen(fresh, seen, pk)


def repaired_deltas(
    log: DataFrame, deltas: DataFrame, days: Column, pk: str, columns: Sequence[str]
) -> tuple[DataFrame, list[dt.date]]:
    """Deltas after some days of a log were loaded again, and the other days whose deltas change.

    The stored deltas, one row per key, are the index of first days. A key that comes earlier now leaves
    the later delta that has it; a key whose first day lost it goes to the next day that holds it. Only the
    deltas of these days are written again, and only where keys were lost is the history of the log searched,
    for those keys. So deltas do not depend on the order in which days are loaded.

    Returns the rows of all deltas to write, those of ``days`` included, and the list of the other days.
    """
    some, rest = log.filter(days), log.filter(~days)
    before, elsewhere = deltas.filter(days), deltas.filter(~days).select(DAY, PLACE, *columns)
    here = dim_delta(some, pk, columns).select(F.col(pk).alias("_key"), F.col(DAY).alias("_day"))
    same = F.col(pk) == F.col("_key")
    late = before.join(here, same, "left").filter(F.col("_day").isNull() | (F.col("_day") > F.col(DAY)))
    lost = late.select(pk)
    if lost.isEmpty():
        gained = elsewhere.limit(0)
    else:
        gained = dim_delta(rest.join(lost, pk, "left_semi"), pk, columns)
        gained = gained.join(here, same & (F.col("_day") < F.col(DAY)), "left_anti")
    moved = elsewhere.join(here, same & (F.col("_day") < F.col(DAY)), "left_semi").select(pk, DAY)
    touched = gained.select(DAY).unionByName(moved.select(DAY)).distinct()
    other = sorted(r[DAY] for r in touched.collect())
    known = elsewhere.select(pk, DAY).unionByName(gained.select(pk, DAY))
    rows = dim_delta_of(some, known, pk, columns)
    if other:
        stay = elsewhere.filter(F.col(DAY).isin(other)).join(moved, [pk, DAY], "left_anti")
        rows = rows.unionByName(stay).unionByName(gained)
    return rows, other


def fact_rows(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows within each day, none removed across days."""
    return log.groupBy(DAY, *columns).agg(F.min(PLACE).alias(PLACE))


def fact_rows_by_key(log: DataFrame, pk: str, columns: Sequence[str]) -> DataFrame:
    """Facts with one row per key, the last one."""
    return last_per_key(fact_rows(log, columns), pk, [DAY, PLACE])
