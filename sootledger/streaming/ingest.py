"""Drop files as a stream of arrivals, beside an inventory that also sees changed and removed files."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sootledger import domain
from sootledger.files import or_empty
from sootledger.functions.dates import day_of_file
from sootledger.operators.ranking import last_per_key
from sootledger.plans.runs import References, load_equipment, load_trips, write_deltas
from sootledger.session import tune
from sootledger.sinks.ledger import Days, Layout
from sootledger.sources.drops import (
    EQUIPMENT_GLOB,
    TRIP_GLOB,
    read_equipment_drops,
    read_trip_drops,
    site_dir_of,
)
from sootledger.sources.warehouse import read_log

GLOBS = {"mission": TRIP_GLOB, "materiel": EQUIPMENT_GLOB}
# What Spark's reader of binary files brings; the content is never asked for.
FILES = "path string, modificationTime timestamp, length long, content binary"
INVENTORY = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("site_dir", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)


def _placed(files: DataFrame) -> DataFrame:
    """Files with the day and site that their names say; only those of the listed sites."""
    placed = files.select(
        "path",
        day_of_file(F.element_at(F.split("path", "/"), -1)).alias("ingest_date"),
        site_dir_of("path").alias("site_dir"),
        F.col("modificationTime").alias("modified"),
        "length",
    )
    return placed.filter(F.col("site_dir").isin(*domain.SITE_CODES) & F.col("ingest_date").isNotNull())


def files_now(spark: SparkSession, drops: str, kind: str) -> DataFrame:
    """The drop files of a kind as they are; nothing of their content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return _placed(reader.option("pathGlobFilter", GLOBS[kind]).load(drops))


def inventory(spark: SparkSession, layout: Layout, kind: str) -> DataFrame:
    """The files that the tables hold, as they were when they were loaded, with the rows each has in the log."""
    path = layout.inventory(kind)
    stored = or_empty(spark, lambda: spark.read.schema(INVENTORY).parquet(path), INVENTORY)
    return last_per_key(stored, "path", ["seq"]).filter(F.col("length").isNotNull())


def differences(now: DataFrame, was: DataFrame, arrived: Iterable[dt.date] | None = None) -> DataFrame:
    """Files that are new, changed or gone; a file that is gone has no length.

    New files count only if they are of the days given in ``arrived``; None means all of them.
    """
    old = was.select("path", *[F.col(c).alias(f"_{c}") for c in ("ingest_date", "site_dir", "modified", "length")])
    both = now.join(old, "path", "full_outer")
    same = F.col("modified").eqNullSafe(F.col("_modified")) & F.col("length").eqNullSafe(F.col("_length"))
    changed = both.filter(~same).withColumn("_known", F.col("_length").isNotNull()).select(
        "path", F.coalesce("ingest_date", "_ingest_date").alias("ingest_date"),
        F.coalesce("site_dir", "_site_dir").alias("site_dir"), "modified", "length", "_known",
    )
    if arrived is not None:
        days = list(arrived)
        changed = changed.filter(F.col("_known") | (F.col("ingest_date").isin(days) if days else F.lit(False)))
    return changed.drop("_known")


def synchronise(
    spark: SparkSession,
    layout: Layout,
    drops: str,
    refs: References,
    kind: str,
    arrived: Iterable[dt.date] | None = None,
) -> list[dt.date]:
    """Load the days of all files that differ from the inventory, then note the files; returns these days.

    Each such day is loaded whole, as a batch run over it would be, so an emptied or removed file leaves no
    rows. The inventory is written last: what fails before is found again.
    """
    changed = differences(files_now(spark, drops, kind), inventory(spark, layout, kind), arrived)
    found = changed.collect()  # names, one row for each file that differs
    if not found:
        return []
    seq = time.time_ns() // 1000
    listed = sorted({r["ingest_date"] for r in found})
    days = Days.of(listed)
    if kind == "mission":
        load_trips(spark, layout, read_trip_drops(spark, drops, days=listed), refs, f"stream-{seq}", days)
    else:
        load_equipment(layout, read_equipment_drops(spark, drops, days=listed), refs, days)
    write_deltas(spark, layout, kind, days)
    rows = read_log(spark, layout, kind).filter(days.predicate).groupBy("ingest_date", "site_dir").agg(
        F.count(F.lit(1)).alias("rows")
    )
    files = spark.createDataFrame(found, changed.schema).join(rows, ["ingest_date", "site_dir"], "left")
    noted = files.withColumns({"rows": F.coalesce("rows", F.lit(0)), "seq": F.lit(seq)})
    noted.select(*INVENTORY.names).coalesce(1).write.mode("append").parquet(layout.inventory(kind))
    return listed


def _arrivals(spark: SparkSession, drops: str, kind: str, max_files: int, waiting: bool) -> DataFrame:
    """What makes a trigger look: files that arrive, or for a stream that goes on, its clock."""
    if waiting:
        return spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", GLOBS[kind]).option("maxFilesPerTrigger", max_files)
    return _placed(reader.load(drops))


def start_ingest(
    spark: SparkSession,
    layout: Layout,
    drops: str,
    refs: References,
    checkpoint: str,
    max_files: int = 10_000,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start one stream per kind of file; by default they stop when all files are loaded.

    Before the first trigger, and at each one, the inventory is compared with the files: a day with a file that
    changed or is gone is loaded again, so the tables equal a batch load of the files that are there. A batch that is
    repeated after a failure leaves the same tables. With a trigger that goes on (``processingTime``) the
    files are compared at each tick, whether or not one arrived.
    """
    tune(spark)
    waiting = bool(trigger) and "processingTime" in trigger

    def handler(kind: str):
        def handle(batch: DataFrame, batch_id: int) -> None:
            session = batch.sparkSession
            arrived = None
            if not waiting:
                arrived = [r["ingest_date"] for r in batch.select("ingest_date").distinct().collect()]
            synchronise(session, layout, drops, refs, kind, arrived)

        return handle

    for kind in GLOBS:
        synchronise(spark, layout, drops, refs, kind, arrived=())
    return [
        _arrivals(spark, drops, kind, max_files, waiting)
        .writeStream.foreachBatch(handler(kind))
        .option("checkpointLocation", f"{checkpoint}/{'clock-' if waiting else ''}{kind}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        for kind in GLOBS
    ]
