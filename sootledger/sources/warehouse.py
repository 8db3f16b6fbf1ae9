"""Readers of the warehouse: snapshots, days, rebuilds and views."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger import schemas
from sootledger.functions.dates import to_day
from sootledger.functions.numbers import to_number
from sootledger.operators.ranking import last_per_key
from sootledger.plans.loading import dim_snapshot, fact_rows
from sootledger.sinks.ledger import Layout, label_paths, read_manifest
from sootledger.files import or_empty, read_delimited
from sootledger.sinks.published import read_published

DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")
LOG_OF = {
    "FAIT_MISSION": "mission", "DIM_MISSION": "mission",
    "FAIT_MATERIEL": "materiel", "DIM_MATERIEL": "materiel",
}


@dataclass(frozen=True)
class Star:
    """The five tables of the warehouse."""

    fait_mission: DataFrame
    fait_materiel: DataFrame
    dim_personnel: DataFrame
    dim_materiel: DataFrame
    dim_mission: DataFrame

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> Star:
        return cls(**{name.lower(): df for name, df in tables.items()})

    def tables(self) -> dict[str, DataFrame]:
        return {f.name.upper(): getattr(self, f.name) for f in fields(self)}


def _empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.WAREHOUSE[table])


def delta_schema(table: str) -> T.StructType:
    schema = T.StructType(list(schemas.WAREHOUSE[table].fields))
    return schema.add("load_order", "long").add("ingest_date", "date")


def read_deltas(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """Deltas of a table; none before its first load."""
    schema = delta_schema(table)
    return or_empty(spark, lambda: spark.read.schema(schema).parquet(layout.delta(table)), schema)


def without_lineage(df: DataFrame, table: str) -> DataFrame:
    """Facts keep the day they came and their place in it, which order rows of one key; dimensions need neither."""
    return df if table in schemas.DATE_COLUMN else df.drop("ingest_date", "load_order")


def load_star(spark: SparkSession, layout: Layout, version: str = "latest") -> Star:
    """A label (``latest``, ``final``, ``init``) or one day, read as that day's delta.

    Only ``latest`` has its own personnel table; every other version uses ``init``'s.
    """
    if DAY.match(version):
        day = F.lit(dt.date.fromisoformat(version))
        tables = {
            t: without_lineage(read_deltas(spark, layout, t).filter(F.col("ingest_date") == day), t)
            for t in LOG_OF
        }
        paths = {}
    else:
        paths = label_paths(spark, layout, version)
        if not paths:
            raise FileNotFoundError(f"no version {version!r} below {layout.root}")
        tables = {t: without_lineage(read_published(spark, p, t), t) for t, p in paths.items()}
    if version != "latest" or "DIM_PERSONNEL" not in tables:
        tables["DIM_PERSONNEL"] = _personnel_of_init(spark, layout)
    return Star.of({t: tables.get(t, _empty(spark, t)) for t in schemas.WAREHOUSE})


def _personnel_of_init(spark: SparkSession, layout: Layout) -> DataFrame:
    path = label_paths(spark, layout, "init").get("DIM_PERSONNEL")
    if path is None:
        raise FileNotFoundError(f"no personnel below {layout.root}: run initialise first")
    return read_published(spark, path, "DIM_PERSONNEL")


def rebuild_from_days(days: DataFrame, pk: str) -> DataFrame:
    """Union of all days, last row per primary key."""
    return last_per_key(days, pk, ["ingest_date", "load_order"])


def load_star_any(spark: SparkSession, layout: Layout) -> Star:
    """``final``, else ``latest``, else rebuilt from the days; personnel falls back to ``init``."""
    tables = {}
    final, latest = (label_paths(spark, layout, x) for x in ("final", "latest"))
    for table in schemas.WAREHOUSE:
        path = final.get(table) or latest.get(table)
        if path:
            tables[table] = without_lineage(read_published(spark, path, table), table)
        elif table == "DIM_PERSONNEL":
            tables[table] = _personnel_of_init(spark, layout)
        else:
            days = read_deltas(spark, layout, table)
            tables[table] = without_lineage(rebuild_from_days(days, schemas.PRIMARY_KEY[table]), table)
    return Star.of(tables)


def log_schema(kind: str) -> T.StructType:
    dim, fact = f"DIM_{kind.upper()}", f"FAIT_{kind.upper()}"
    both = {f.name: f for f in [*schemas.WAREHOUSE[fact].fields, *schemas.WAREHOUSE[dim].fields]}
    schema = T.StructType(list(both.values())).add("load_order", "long")
    return schema.add("ingest_date", "date").add("site_dir", "string")


def read_log(spark: SparkSession, layout: Layout, kind: str) -> DataFrame:
    schema = log_schema(kind)
    return or_empty(spark, lambda: spark.read.schema(schema).parquet(layout.log(kind)), schema)


def facts_of(log: DataFrame, kind: str) -> DataFrame:
    """Facts of the days of a log, with their lineage."""
    return fact_rows(log, schemas.names(schemas.WAREHOUSE[f"FAIT_{kind.upper()}"]))


def dimension_of(log: DataFrame, kind: str) -> DataFrame:
    """Last row of each key of a log, with its lineage."""
    dim = f"DIM_{kind.upper()}"
    return dim_snapshot(log, schemas.PRIMARY_KEY[dim], schemas.names(schemas.WAREHOUSE[dim]))


def as_of(spark: SparkSession, layout: Layout, day: dt.date) -> Star:
    """Full tables as they were at the end of a day."""
    tables = {"DIM_PERSONNEL": _personnel_of_init(spark, layout)}
    for kind in ("mission", "materiel"):
        log = read_log(spark, layout, kind).filter(F.col("ingest_date") <= F.lit(day))
        tables[f"FAIT_{kind.upper()}"] = facts_of(log, kind)
        dim = f"DIM_{kind.upper()}"
        tables[dim] = without_lineage(dimension_of(log, kind), dim)
    return Star.of(tables)


def days_of(*facts: DataFrame) -> DataFrame:
    """Distinct days of some frames with ingest_date, ascending."""
    each = [df.select("ingest_date").distinct() for df in facts]
    return reduce(DataFrame.unionByName, each).distinct().orderBy("ingest_date")


def days_available(spark: SparkSession, layout: Layout) -> DataFrame:
    """Days that brought rows, ascending: every such day has facts of one kind or the other."""
    return days_of(*(read_deltas(spark, layout, t) for t in ("FAIT_MISSION", "FAIT_MATERIEL")))


def versions_available(spark: SparkSession, layout: Layout) -> DataFrame:
    """Everything ``load_star`` accepts: ``latest`` first, then descending by name."""
    days = days_available(spark, layout).select(F.col("ingest_date").cast("string").alias("version"))
    labels = read_manifest(spark, layout).select(F.col("label").alias("version"))
    return days.unionByName(labels).distinct().orderBy(
        F.col("version") != "latest", F.col("version").desc()
    )


def register_views(star: Star) -> None:
    """The five tables as temporary SQL views."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)


def load_metadata(spark: SparkSession, layout: Layout) -> DataFrame:
    """When, from what kind of source, and over how many days the tables were loaded."""
    snapshot = any("FAIT_MISSION" in label_paths(spark, layout, x) for x in ("final", "latest"))
    return days_available(spark, layout).agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
        F.lit("snapshot" if snapshot else "daily_folders").alias("source"),
        F.count("ingest_date").alias("day_folders"),
    )


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A warehouse table from CSV; bad dates and numbers become NULL, absent gives empty."""
    schema = schemas.WAREHOUSE[table]

    def read():
        raw = read_delimited(spark, path, ",")
        parse = {"date": to_day, "double": to_number}
        return raw.select(
            *[
                parse.get(f.dataType.typeName(), F.col)(f.name).alias(f.name)
                for f in schema.fields
                if f.name in raw.columns
            ]
        )

    return or_empty(spark, read, schema)
