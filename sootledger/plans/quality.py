"""Data-quality reports over the log of loaded rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sootledger.operators.aggregates import load_counts
from sootledger.operators.sets import stack, tagged

WATCHED = {"mission": ["ID_SITE", "DISTANCE_KM", "IMPACT"], "materiel": ["ID_SITE", "IMPACT"]}


def load_quality(log: DataFrame, table: str, watched: list[str]) -> DataFrame:
    """Rows and missing values per day and site of one table."""
    present = [c for c in watched if c in log.columns]
    return tagged(load_counts(log, ["ingest_date", "site_dir"], present), table, "table_name")


def quality_report(logs: dict[str, DataFrame]) -> DataFrame:
    """One line per table, day and site, with the percentage of rows without impact."""
    parts = [load_quality(df, kind, WATCHED[kind]) for kind, df in logs.items()]
    return stack(*parts).withColumn(
        "missing_impact_pct", F.lit(100.0) * F.col("missing_IMPACT") / F.col("n_rows")
    )


def missing_columns(frames: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, list[str]]:
    """Expected columns that a frame does not have, per table."""
    return {t: [c for c in cols if c not in df.columns] for t, (df, cols) in frames.items()}
