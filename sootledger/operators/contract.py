"""Schema contract: which columns are kept, what they are called, what is missing."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger.functions.text import clean_name

log = logging.getLogger(__name__)


def clean_header(df: DataFrame, fold: bool = False) -> DataFrame:
    return df.toDF(*[clean_name(c, fold) for c in df.columns])


def keep_columns(
    df: DataFrame, columns: Iterable[str], also: Iterable[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Project to a keep-list in its order. Missing columns are reported, not fatal.

    ``also`` names columns that travel along (lineage) and are never reported.
    """
    df = clean_header(df)
    wanted = [clean_name(c) for c in columns]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("expected columns are absent: %s", missing)
    kept = [c for c in wanted if c in df.columns]
    return df.select(*kept, *[c for c in also if c in df.columns]), missing


def as_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Absent text columns as NULL, so that a job goes on without them."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema, cast to its types, NULL where absent."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
