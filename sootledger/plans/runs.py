"""Runs over the drop folder: initialise, load a range of days, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger import domain, schemas
from sootledger.operators.contract import conform
from sootledger.operators.ranking import last_per_key
from sootledger.plans.enrich import (
    clean_equipment,
    clean_trip_rows,
    distance_reference,
    distinct_trip_rows,
    missing_distances,
    personnel_dimension,
)
from sootledger.plans.loading import repaired_deltas
from sootledger.session import cut_lineage, tune
from sootledger.sinks.ledger import (
    Days,
    Layout,
    append_distances,
    delete_folders,
    files_of,
    fold_distances,
    last_complete,
    publish,
    read_changes,
    record_change,
    stored_distances,
    write_days,
)
from sootledger.sinks.published import Part, bucket_of, read_listing, read_parts
from sootledger.sources.drops import (
    read_equipment_drops,
    read_personnel_drops,
    read_trip_drops,
    read_trip_places,
)
from sootledger.sources.references import (
    band_factors,
    read_coordinates,
    read_distances,
    read_factor_table,
    read_impacts,
    split_impacts,
)
from sootledger.sources.warehouse import (
    delta_schema,
    dimension_of,
    facts_of,
    log_schema,
    read_deltas,
    read_log,
)

LOG_PARTITIONS = ("ingest_date", "site_dir")


@dataclass(frozen=True)
class References:
    """Lookup tables of the enrichment."""

    by_model: DataFrame
    by_type: DataFrame
    distances: DataFrame
    bands: DataFrame
    coordinates: DataFrame


def read_references(spark: SparkSession, paths: Mapping[str, str]) -> References:
    """References from files; an absent file (other than factors) is an empty table.

    Paths: ``impacts``, ``distances``, ``transports``, ``cars``, ``coordinates``.
    """
    by_model, by_type = split_impacts(read_impacts(spark, paths["impacts"]))
    return References(
        by_model=by_model,
        by_type=by_type,
        distances=read_distances(spark, paths["distances"]),
        bands=band_factors(
            read_factor_table(spark, paths["transports"]), read_factor_table(spark, paths["cars"])
        ),
        coordinates=read_coordinates(spark, paths["coordinates"]),
    )


def with_stored_distances(spark: SparkSession, layout: Layout, refs: References) -> References:
    """References completed with the distances that earlier loads computed, which count before those given."""
    given = refs.distances.withColumns(
        {"added_at": F.lit(None).cast("timestamp"), "load": F.lit(None).cast("string")}
    )
    every = stored_distances(spark, layout).unionByName(given)
    newest = last_per_key(every, domain.DISTANCE_KEYS, ["added_at", "load"])
    return replace(refs, distances=newest.drop("added_at", "load"))


def build_distances(
    spark: SparkSession, layout: Layout, drops: str, coordinates: DataFrame
) -> None:
    """Distances of all pairs in the trip files, written as one full load."""
    pairs = distance_reference(read_trip_places(spark, drops), coordinates)
    append_distances(pairs, layout, "full", refresh=True)


def load_trips(
    spark: SparkSession, layout: Layout, raw: DataFrame, refs: References, load: str, days: Days
) -> None:
    """Trips into the log. Distances that had to be computed are stored first.

    ``days`` are all days that ``raw`` covers: what the log holds of them and ``raw`` does not is removed.

    One scan of the text lands the distinct rows, without names, as Parquet; distances and cleaning read that.
    The stored distances, not the plan that computed them, feed the join: their size is
    known to Catalyst and a lost executor does not recompute them.
    """
    record_change(spark, layout, "mission", days)
    landing = layout.landing(f"mission-{load}")
    landed = distinct_trip_rows(raw)
    landed.write.mode("overwrite").parquet(landing)
    rows = spark.read.schema(landed.schema).parquet(landing)
    known = cut_lineage(with_stored_distances(spark, layout, refs).distances)
    added = append_distances(missing_distances(rows, known, refs.coordinates), layout, load)
    distances = known.filter(F.col("DISTANCE_KM").isNotNull()).unionByName(added.select(*known.columns))
    trips = clean_trip_rows(rows, distances, refs.bands)
    write_days(trips, layout.log("mission"), LOG_PARTITIONS, _covered(spark, layout, "mission", days))
    delete_folders(spark, [landing])
    fold_distances(spark, layout)


def load_equipment(layout: Layout, raw: DataFrame, refs: References, days: Days) -> None:
    """Equipment into the log; ``days`` as for trips."""
    spark = raw.sparkSession
    record_change(spark, layout, "materiel", days)
    goods = clean_equipment(raw, refs.by_model, refs.by_type)
    write_days(goods, layout.log("materiel"), LOG_PARTITIONS, _covered(spark, layout, "materiel", days))


def _covered(spark: SparkSession, layout: Layout, kind: str, days: Days):
    return lambda: files_of(spark, layout.log(kind), log_schema(kind), days.predicate)


def write_deltas(spark: SparkSession, layout: Layout, kind: str, days: Days) -> None:
    """Deltas of some days: new dimension keys and the day's facts.

    Deltas stored for these days are replaced, by nothing where a day has no new key or fact any more.
    Deltas of other days change where the loaded days bring a key first, or do so no more.
    """
    log = read_log(spark, layout, kind)
    fact, dim = f"FAIT_{kind.upper()}", f"DIM_{kind.upper()}"
    columns = schemas.names(schemas.WAREHOUSE[dim])
    rows, other = repaired_deltas(
        log, read_deltas(spark, layout, dim), days.predicate, schemas.PRIMARY_KEY[dim], columns
    )
    all_days = Days((*days.ranges, *Days.of(other).ranges))
    for table, df, those in ((dim, rows, all_days), (fact, facts_of(log.filter(days.predicate), kind), days)):
        write_days(
            df, layout.delta(table),
            covered=lambda: files_of(spark, layout.delta(table), delta_schema(table), those.predicate),
        )


def initialise(spark: SparkSession, layout: Layout, drops: str) -> int:
    """Empty facts and dimensions plus the personnel of all sites, published as ``init``."""
    tune(spark)
    tables = {t: spark.createDataFrame([], s) for t, s in schemas.WAREHOUSE.items()}
    people = personnel_dimension(read_personnel_drops(spark, drops))
    tables["DIM_PERSONNEL"] = conform(people, schemas.DIM_PERSONNEL)
    return publish(spark, layout, tables, ("init",))


def publish_snapshots(
    spark: SparkSession,
    layout: Layout,
    labels: tuple[str, ...] = ("latest", "final"),
    full: bool = False,
) -> int:
    """Full tables from the log; personnel stays the copy of ``init``.

    Beside the newest full version only days that were loaded since are read: facts get the parts of these
    days, dimensions the buckets of the keys that came with them. All other parts are referenced. ``full``,
    or another number of buckets, builds everything from the log, with the same rows.
    """
    base = None if full else last_complete(spark, layout)
    tables, kept, seen = {}, {}, 0
    for kind in ("mission", "materiel"):
        changes = read_changes(spark, layout, kind).collect()  # one row for each load
        seen = max([seen, *(r["seq"] for r in changes)])
        fact, dim = f"FAIT_{kind.upper()}", f"DIM_{kind.upper()}"
        log = read_log(spark, layout, kind)
        stored = {t: read_listing(spark, base[1][t]) for t in (fact, dim)} if base else {}
        if base is None or any(p.buckets != layout.buckets for parts in stored.values() for p in parts):
            tables[fact], tables[dim] = facts_of(log, kind), dimension_of(log, kind)
            continue
        days = Days(tuple({(r["first"], r["last"]) for r in changes if r["seq"] > base[0]}))
        tables[fact] = facts_of(log.filter(days.predicate), kind)
        kept[fact] = [p for p in stored[fact] if dt.date.fromisoformat(p.part) not in days]
        again = len(kept[fact]) < len(stored[fact])
        tables[dim], touched = changed_buckets(log, stored[dim], days.predicate, kind, layout.buckets, again)
        kept[dim] = [p for p in stored[dim] if p.part not in touched]
    return publish(
        spark, layout, tables, labels, unchanged={"DIM_PERSONNEL": "init"}, kept=kept, seen=seen
    )


def changed_buckets(
    log: DataFrame, parts: Sequence[Part], days: Column, kind: str, buckets: int, again: bool
) -> tuple[DataFrame, set[str]]:
    """Rows of the buckets of a dimension that some loaded days change, and these buckets.

    ``parts`` are the published ones, of which only the changed ones are read. ``again`` says that they may hold
    rows of these days: then keys whose last row was one of them are looked up in the rest of the log.
    """
    dim = f"DIM_{kind.upper()}"
    key, spark = schemas.PRIMARY_KEY[dim], log.sparkSession
    came = dimension_of(log.filter(days), kind)
    named = came.select(key)
    if again:
        gone = read_parts(spark, dim, parts).filter(days).select(key)
        came = came.unionByName(dimension_of(log.filter(~days).join(gone, key, "left_semi"), kind))
        named = named.unionByName(gone)
    bucket = bucket_of(key, buckets).cast("string").alias("bucket")
    touched = {r["bucket"] for r in named.select(bucket).distinct().collect()}
    stay = read_parts(spark, dim, [p for p in parts if p.part in touched]).filter(~days)
    rows = stay.select(*came.columns).unionByName(came)
    return last_per_key(rows, key, ["ingest_date", "load_order"]), touched


def run_range(
    spark: SparkSession,
    layout: Layout,
    drops: str,
    refs: References,
    start: dt.date = domain.FIRST_DAY,
    end: dt.date = domain.LAST_DAY,
    labels: tuple[str, ...] = ("latest", "final"),
) -> None:
    """Load an inclusive range of days of all sites in one pass; running it again is harmless."""
    tune(spark)
    load = f"{start:%Y%m%d}-{end:%Y%m%d}"
    days = Days(((start, end),))
    load_trips(spark, layout, read_trip_drops(spark, drops, start, end), refs, load, days)
    load_equipment(layout, read_equipment_drops(spark, drops, start, end), refs, days)
    for kind in ("mission", "materiel"):
        write_deltas(spark, layout, kind, days)
    if labels:
        publish_snapshots(spark, layout, labels)


def run_day(
    spark: SparkSession, layout: Layout, drops: str, refs: References, day: dt.date
) -> bool:
    """Load one day; tells whether it brought any row. Snapshots are published separately."""
    run_range(spark, layout, drops, refs, day, day, labels=())
    today = F.col("ingest_date") == F.lit(day)
    return any(
        not read_log(spark, layout, kind).filter(today).isEmpty()
        for kind in ("mission", "materiel")
    )
