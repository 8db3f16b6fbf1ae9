"""Daily drop files of all sites and days, read as one frame.

Expected names, anywhere below the root:
``…_<SITE>_MISSION/MISSION_<yyyymmdd>.txt``,
``…_<SITE>_INFORMATIQUE/MATERIEL_INFORMATIQUE_<yyyymmdd>.txt`` and
``PERSONNEL_<SITE>.txt``. A site or day without a file contributes no row, and files of
sites that are not listed are not loaded.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger import domain, schemas
from sootledger.functions.dates import day_of_file
from sootledger.functions.text import na_to_null, strip
from sootledger.operators.ranking import listed_rank
from sootledger.files import existing, folders_below, read_delimited, row_position

TRIP_GLOB = "MISSION_*.txt"
EQUIPMENT_GLOB = "MATERIEL_INFORMATIQUE_*.txt"
PERSONNEL_GLOB = "PERSONNEL_*.txt"

_ROWS_PER_SITE_BITS = 50

# Up to so many days, files are asked for by name; beyond, the whole tree is listed.
ADDRESSED = 7


def site_dir_of(path: Column | str) -> Column:
    """Site code in the folder of a daily file or in the name of a personnel file."""
    daily = F.regexp_extract(path, r"([^/_]+)_(?:MISSION|INFORMATIQUE)/[^/]*$", 1)
    personnel = F.regexp_extract(path, r"PERSONNEL_([^/]+)\.txt$", 1)
    return F.coalesce(F.nullif(daily, F.lit("")), F.nullif(personnel, F.lit("")))


def load_order(site_dir: Column, position: Column, sites: Sequence[str]) -> Column:
    """One number that orders the rows of a day: site in list order, then file order."""
    rank = listed_rank("site_dir", sites).cast("long")
    return F.shiftleft(rank, _ROWS_PER_SITE_BITS) + position


def drop_stream_columns(df: DataFrame) -> DataFrame:
    """Keep what lineage needs from the file metadata."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def with_lineage(
    df: DataFrame,
    sites: Sequence[str] = domain.SITE_CODES,
    start: dt.date | None = None,
    end: dt.date | None = None,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Add ingest_date, site_dir and load_order; keep only files of the listed sites and of some days.

    These filters sit below the row numbering, so they prune whole files.
    """
    df = df.withColumn("ingest_date", day_of_file("_file"))
    if start:
        df = df.filter(F.col("ingest_date") >= F.lit(start))
    if end:
        df = df.filter(F.col("ingest_date") <= F.lit(end))
    if days is not None:
        df = df.filter(F.col("ingest_date").isin(list(days)) if days else F.lit(False))
    df = df.withColumn("site_dir", site_dir_of("_path")).filter(F.col("site_dir").isin(*sites))
    position = row_position(F.col("_start"))
    df = df.withColumn("load_order", load_order(F.col("site_dir"), position, sites))
    return df.drop("_path", "_file", "_start")


def dedupe_file_rows(df: DataFrame, kept: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicates inside one file become one row, at the first one's place.

    ``kept`` names the columns that go on, lineage aside. The others count for equality only: a digest of them
    goes through the shuffle, not the names of people.
    """
    keys = [c for c in df.columns if c != "load_order"]
    rest = [c for c in keys if kept is not None and c not in kept and c not in schemas.LINEAGE]
    if rest:
        keys = [c for c in keys if c not in rest] + ["_rest"]
        df = df.withColumn("_rest", F.unhex(F.sha2(F.to_json(F.struct(*rest)), 256)))
    return df.groupBy(*keys).agg(F.min("load_order").alias("load_order")).drop("_rest")


def no_value_to_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    columns = [c for c in schemas.names(schema) if c in df.columns]
    return df.withColumns({c: na_to_null(c) for c in columns})


def addressed(
    spark: SparkSession, root: str, glob: str, days: Sequence[dt.date], sites: Sequence[str]
) -> list[str]:
    """The files of some days and sites, by their names: only folders above the daily ones are listed."""
    kind = "MISSION" if glob == TRIP_GLOB else "INFORMATIQUE"
    folder = re.compile(rf"(.*_)?({'|'.join(map(re.escape, sites))})_{kind}")
    folders = folders_below(spark, root, lambda name: bool(folder.fullmatch(name)))
    return existing(spark, (f"{f}/{glob.replace('*', day.strftime('%Y%m%d'))}" for f in folders for day in days))


def _read_daily(spark, root, schema, glob, start, end, sites, header, days) -> DataFrame:
    layout = T.StructType([T.StructField(c, T.StringType()) for c in header]) if header else schema
    if days is None and start and end and (end - start).days < ADDRESSED:
        days = [start + dt.timedelta(k) for k in range((end - start).days + 1)]
    if days is None or len(days) > ADDRESSED:
        df = drop_stream_columns(read_delimited(spark, root, ";", layout, glob))
    elif paths := addressed(spark, root, glob, days, sites):
        df = drop_stream_columns(read_delimited(spark, paths, ";", layout))
    else:
        placed = T.StructType(list(layout.fields)).add("_path", "string").add("_file", "string").add("_start", "long")
        df = spark.createDataFrame([], placed)
    return no_value_to_null(with_lineage(df, sites, start, end, days), schema)


def read_trip_drops(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    sites: Sequence[str] = domain.SITE_CODES,
    header: Sequence[str] | None = None,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Trip files of a range of days, or of some ``days``; ``header`` names the columns of another layout."""
    return _read_daily(spark, root, schemas.RAW_TRIP, TRIP_GLOB, start, end, sites, header, days)


def read_equipment_drops(
    spark: SparkSession,
    root: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    sites: Sequence[str] = domain.SITE_CODES,
    header: Sequence[str] | None = None,
    days: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Equipment files of a range of days, or of some ``days``; ``header`` as for trips."""
    return _read_daily(
        spark, root, schemas.RAW_EQUIPMENT, EQUIPMENT_GLOB, start, end, sites, header, days
    )


def read_personnel_drops(
    spark: SparkSession,
    root: str,
    sites: Sequence[str] = domain.SITE_CODES,
    header: Sequence[str] | None = None,
) -> DataFrame:
    """Personnel files, one per site; no file at all gives an empty frame."""
    layout = (
        T.StructType([T.StructField(c, T.StringType()) for c in header])
        if header
        else schemas.RAW_PERSONNEL
    )
    df = drop_stream_columns(read_delimited(spark, root, ";", layout, PERSONNEL_GLOB))
    df = with_lineage(df, sites).drop("ingest_date")
    return no_value_to_null(df, schemas.RAW_PERSONNEL)


def read_trip_places(spark: SparkSession, root: str) -> DataFrame:
    """The four place columns of every trip file; it is an error when there is none."""
    df = read_delimited(spark, root, ";", schemas.RAW_TRIP, TRIP_GLOB)
    if not df.inputFiles():
        raise FileNotFoundError(f"no trip file below {root}")
    return df.select(*[strip(na_to_null(c)).alias(c) for c in domain.DISTANCE_KEYS])
