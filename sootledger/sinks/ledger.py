"""Storage of the warehouse: plain Parquet folders below one root.

log/<table>/ingest_date=…/site_dir=…   cleaned rows, one partition per drop file
delta/<table>/ingest_date=…            what a day added
snapshot/<table>/v=N                   full tables, never overwritten once published
manifest/                              which snapshot a label (init, latest, final) means
landing/…                              rows of a load that is running
inventory/<kind>                       drop files as the stream loaded them
changes/<kind>, published/             days that loads may have changed; the last one a version includes
distances/load=…                       city-pair distances that loads added
distances_folded/v=N, pointer          the newest row of each pair, once many loads have added some
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger import schemas
from sootledger.domain import DISTANCE_KEYS
from sootledger.files import CSV_WRITE_OPTIONS, or_empty
from sootledger.operators.ranking import last_per_key
from sootledger.sinks.published import Part, write_listing, write_parts

MANIFEST = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)
PUBLISHED = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("seen", T.LongType())]
)
CHANGES = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("seq", T.LongType()),
    ]
)
DISTANCES = T.StructType(list(schemas.DISTANCE_REFERENCE.fields))
DISTANCES = DISTANCES.add("added_at", "timestamp").add("load", "string")
FOLD = 16  # loads that add distances before they are folded


@dataclass(frozen=True)
class Layout:
    """Where the warehouse lies, and in how many buckets its published tables are.

    Choose the buckets so that a bucket of the largest dimension fits a task.
    """

    root: str
    buckets: int = 8

    def log(self, table: str) -> str:
        return f"{self.root}/log/{table}"

    def delta(self, table: str) -> str:
        return f"{self.root}/delta/{table}"

    def snapshot(self, table: str, version: int) -> str:
        return f"{self.root}/snapshot/{table}/v={version}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    def landing(self, load: str) -> str:
        return f"{self.root}/landing/{load}"

    def inventory(self, kind: str) -> str:
        return f"{self.root}/inventory/{kind}"

    def changes(self, kind: str) -> str:
        return f"{self.root}/changes/{kind}"

    @property
    def published(self) -> str:
        return f"{self.root}/published"

    @property
    def distances(self) -> str:
        return f"{self.root}/distances"

    @property
    def folded(self) -> str:
        return f"{self.root}/distances_folded"


def files_of(spark: SparkSession, path: str, schema: T.StructType, rows: Column) -> set[str]:
    """Files below a path that hold rows under a condition (names only, for partitions a load covers)."""

    def read():
        stored = spark.read.schema(schema).parquet(path)
        return stored.filter(rows).select(F.col("_metadata.file_path").alias("file")).distinct()

    listed = or_empty(spark, read, T.StructType([T.StructField("file", T.StringType())]))
    return {r["file"] for r in listed.collect()}


def delete_folders(spark: SparkSession, folders: Iterable[str], encoded: bool = False) -> None:
    """Remove folders of a table, ``encoded`` as Spark names files; one that is gone already is no error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in sorted(folders):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder) if encoded else folder)
        path.getFileSystem(conf).delete(path, True)


def write_days(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...] = ("ingest_date",),
    covered: Callable[[], set[str]] | None = None,
) -> None:
    """Replace exactly the partitions present in the frame; the others stay.

    ``covered`` lists the files of stored partitions that the load covers. Those that are still there
    afterwards belong to partitions that bring no rows any more: they are removed, so that nobody reads
    them. A run that dies in between leaves them, and is repeated.
    The rebalance hint groups rows by partition before the write, and adaptive
    execution splits a partition that holds too many of them, so there are
    neither thousands of small files nor one huge task.
    """
    before = covered() if covered else set()
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    if before:
        delete_folders(df.sparkSession, {f.rsplit("/", 1)[0] for f in before & covered()}, encoded=True)


def read_manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    return or_empty(
        spark, lambda: spark.read.schema(MANIFEST).json(layout.manifest), MANIFEST
    )


def label_paths(spark: SparkSession, layout: Layout, label: str) -> dict[str, str]:
    """Table paths of the newest version published under a label (a handful of rows)."""
    rows = read_manifest(spark, layout).filter(F.col("label") == label)
    newest = rows.agg(F.max("version").alias("version"))
    return {r["table"]: r["path"] for r in rows.join(newest, "version").collect()}


def next_version(spark: SparkSession, layout: Layout) -> int:
    top = read_manifest(spark, layout).agg(F.max("version")).first()[0]
    return (top or 0) + 1


def publish(
    spark: SparkSession,
    layout: Layout,
    tables: Mapping[str, DataFrame],
    labels: tuple[str, ...] = ("latest",),
    unchanged: Mapping[str, str] | None = None,
    kept: Mapping[str, Sequence[Part]] | None = None,
    seen: int | None = None,
) -> int:
    """Write a new version of some tables, then point labels at it.

    ``unchanged`` maps a table to the label whose copy is still valid: its path
    is referenced, nothing is copied. ``kept`` names parts of earlier versions that
    stay in a table beside the rows given for it. ``seen`` is the last change of the log
    that the version includes. Readers see either the old or the new
    version, because the manifest row is written last.
    """
    version = next_version(spark, layout)
    paths = {}
    for table, label in (unchanged or {}).items():
        there = label_paths(spark, layout, label).get(table)
        if there is None:
            raise FileNotFoundError(f"no {table} published as {label!r} below {layout.root}")
        paths[table] = there
    for table, df in tables.items():
        if table not in paths:
            paths[table] = path = layout.snapshot(table, version)
            parts = write_parts(df, table, path, layout.buckets)
            write_listing(spark, path, [*parts, *(kept or {}).get(table, ())])
    if seen is not None:
        rows = spark.createDataFrame([(version, seen)], PUBLISHED)
        rows.coalesce(1).write.mode("append").json(layout.published)
    rows = [(label, version, t, p) for label in labels for t, p in paths.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(layout.manifest)
    return version


@dataclass(frozen=True)
class Days:
    """Days as inclusive ranges."""

    ranges: tuple[tuple[dt.date, dt.date], ...]

    @classmethod
    def of(cls, days: Iterable[dt.date]) -> Days:
        return cls(tuple((d, d) for d in sorted(set(days))))

    def __contains__(self, day: dt.date) -> bool:
        return any(a <= day <= b for a, b in self.ranges)

    @property
    def predicate(self) -> Column:
        """Condition on ingest_date, true or false."""
        singles = [a for a, b in self.ranges if a == b]
        found = F.col("ingest_date").isin(singles) if singles else F.lit(False)
        for a, b in self.ranges:
            if a != b:
                found = found | F.col("ingest_date").between(F.lit(a), F.lit(b))
        return found


def record_change(spark: SparkSession, layout: Layout, kind: str, days: Days) -> None:
    """Note, before a load writes, which days it may change; a kind is loaded, or all is published, by one writer at a time."""
    seq = time.time_ns() // 1000
    rows = [(kind, a, b, seq) for a, b in days.ranges]
    spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").json(layout.changes(kind))


def read_changes(spark: SparkSession, layout: Layout, kind: str) -> DataFrame:
    return or_empty(spark, lambda: spark.read.schema(CHANGES).json(layout.changes(kind)), CHANGES)


def last_complete(spark: SparkSession, layout: Layout) -> tuple[int, dict[str, str]] | None:
    """The last change that the newest published full version includes, and the paths of its tables."""
    seen = or_empty(spark, lambda: spark.read.schema(PUBLISHED).json(layout.published), PUBLISHED)
    rows = read_manifest(spark, layout).join(seen, "version")
    newest = rows.join(rows.agg(F.max("version").alias("version")), "version").collect()
    return (newest[0]["seen"], {r["table"]: r["path"] for r in newest}) if newest else None


def append_distances(
    df: DataFrame, layout: Layout, load: str, refresh: bool = False
) -> DataFrame:
    """Add distance rows under a load label, and return them as they are stored.

    Readers take the newest row of a pair. Rows are appended, never replaced: a load that runs again brings only the
    pairs it still lacked. ``refresh`` replaces the rows of the label instead.
    """
    stamp = dt.datetime.now(dt.timezone.utc)
    rows = df.withColumn("added_at", F.lit(stamp)).withColumn("load", F.lit(load))
    if refresh:
        write_days(rows, layout.distances, ("load",))
    else:
        rows.write.mode("append").partitionBy("load").parquet(layout.distances)
    stored = added_distances(df.sparkSession, layout)
    return stored.filter((F.col("load") == load) & (F.col("added_at") == F.lit(stamp)))


def added_distances(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows of loads that are not folded yet."""
    return or_empty(spark, lambda: spark.read.schema(DISTANCES).parquet(layout.distances), DISTANCES)


def stored_distances(spark: SparkSession, layout: Layout) -> DataFrame:
    """The folded distances and what loads added since; a pair can have several rows."""
    added, version = added_distances(spark, layout), _fold_version(spark, layout)
    if not version:
        return added
    folded = spark.read.schema(DISTANCES).parquet(f"{layout.folded}/v={version}")
    return folded.unionByName(added)


def _fold_version(spark: SparkSession, layout: Layout) -> int:
    schema = T.StructType([T.StructField("version", T.LongType())])
    pointer = or_empty(spark, lambda: spark.read.schema(schema).json(f"{layout.folded}/pointer"), schema)
    return pointer.agg(F.max("version")).first()[0] or 0


def fold_distances(spark: SparkSession, layout: Layout, least: int = FOLD) -> bool:
    """Once so many loads have added rows, write the newest row of each pair as one table and point to it.

    What is folded is removed after the pointer is written, so a run that dies in between leaves rows twice,
    which readers do not notice. One version before the new one stays for those who are reading it.
    """
    folders = {f.rsplit("/", 1)[0] for f in files_of(spark, layout.distances, DISTANCES, F.lit(True))}
    if len(folders) < max(least, 1):
        return False
    version = _fold_version(spark, layout)
    newest = last_per_key(stored_distances(spark, layout), DISTANCE_KEYS, ["added_at", "load"])
    newest.hint("rebalance").write.mode("overwrite").parquet(f"{layout.folded}/v={version + 1}")
    pointer = spark.createDataFrame([(version + 1,)], "version long")
    pointer.coalesce(1).write.mode("append").json(f"{layout.folded}/pointer")
    delete_folders(spark, folders, encoded=True)
    if version > 1:
        delete_folders(spark, [f"{layout.folded}/v={version - 1}"])
    return True


def export_csv(df: DataFrame, path: str, by_day: bool = False) -> None:
    """CSV with header; an empty frame still writes its header line."""
    if by_day:
        write = df.hint("rebalance", "ingest_date").write.partitionBy("ingest_date")
        write = write.option("partitionOverwriteMode", "dynamic")
    else:
        write = (df.coalesce(1) if df.isEmpty() else df).write
    write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)
