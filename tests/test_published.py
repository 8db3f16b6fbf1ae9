"""Incremental publishing, deltas under re-runs in any order, and the order of sent rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks.mapping import star as mapped_star
from sootledger import schemas
from sootledger.plans import loading, panels, runs
from sootledger.sinks import Days, Layout, publish, published
from sootledger.sinks.ledger import label_paths
from sootledger.sources import load_star, read_equipment_drops
from sootledger.sources.warehouse import read_deltas
from sootledger.streaming.ingest import inventory, start_ingest, synchronise
from tests.conftest import rows
from tests.test_runs import buy, trip

DAYS = [dt.date(2026, 6, d) for d in range(1, 7)]
PARIS = "KeyPers_Paris_1"


@pytest.fixture(scope="module")
def refs(spark, reference_files):
    return runs.read_references(spark, reference_files)


def everything(star):
    names = schemas.WAREHOUSE
    return {t: rows(df, *schemas.names(names[t])) for t, df in star.tables().items()}


def parts_of(spark, layout, table):
    path = label_paths(spark, layout, "latest")[table]
    return path, {p.part: p.location for p in published.read_listing(spark, path)}


def load_goods(spark, layout, root, refs, start, end):
    """A run over some days, equipment only."""
    days = Days(((start, end),))
    runs.load_equipment(layout, read_equipment_drops(spark, root, start, end), refs, days)
    runs.write_deltas(spark, layout, "materiel", days)


def test_publish_reads_and_writes_what_days_changed(spark, drops, refs, tmp_path):
    drops.people("PARIS", [f"{PARIS};DRH;1990-03-01;2020-01-01 00:00:00"])
    for i, day in enumerate(DAYS[:4]):
        drops.goods("PARIS", day, [buy(f"b{20 * i + k}", PARIS, day) for k in range(30)])
    layout, root = Layout(str(tmp_path / "w"), buckets=16), str(drops.root)
    runs.initialise(spark, layout, root)
    load_goods(spark, layout, root, refs, DAYS[0], DAYS[3])
    runs.publish_snapshots(spark, layout)
    first, before = parts_of(spark, layout, "DIM_MATERIEL")
    assert set(before) == {str(b) for b in range(16)}

    # A new day with two keys: two buckets at most and one day of facts are new, the rest is referenced.
    drops.goods("PARIS", DAYS[4], [buy("b3", PARIS, DAYS[4], model="OMEN"), buy("new", PARIS, DAYS[4])])
    load_goods(spark, layout, root, refs, DAYS[4], DAYS[4])
    runs.publish_snapshots(spark, layout)
    second, after = parts_of(spark, layout, "DIM_MATERIEL")
    changed = {p for p in after if after[p] != before[p]}
    assert 1 <= len(changed) <= 2 and all(after[p].startswith(second) for p in changed)
    path, facts = parts_of(spark, layout, "FAIT_MATERIEL")
    assert set(facts) == {str(d) for d in DAYS[:5]}
    assert [p for p, at in facts.items() if at.startswith(path)] == [str(DAYS[4])]
    # Nothing was loaded: nothing is written.
    runs.publish_snapshots(spark, layout)
    path, facts_again = parts_of(spark, layout, "FAIT_MATERIEL")
    assert facts_again == facts

    # Early days again: other rows, rows that are gone, a whole day that is gone.
    drops.goods("PARIS", DAYS[1], [buy("b3", PARIS, DAYS[1], "Ecran", "OMEN"), buy("b25", PARIS, DAYS[1])])
    drops.goods("PARIS", DAYS[2], [])
    load_goods(spark, layout, root, refs, DAYS[1], DAYS[2])
    runs.publish_snapshots(spark, layout)
    drops.goods("PARIS", DAYS[4], [buy("new", PARIS, DAYS[4])])
    load_goods(spark, layout, root, refs, DAYS[4], DAYS[4])
    runs.publish_snapshots(spark, layout)
    small = everything(load_star(spark, layout))
    assert set(parts_of(spark, layout, "FAIT_MATERIEL")[1]) == {str(DAYS[k]) for k in (0, 1, 3, 4)}
    runs.publish_snapshots(spark, layout, full=True)
    assert everything(load_star(spark, layout)) == small
    model = {r[0]: r[1] for r in rows(load_star(spark, layout).dim_materiel, "ID_MATERIEL", "MODELE")}
    assert model["b3"] == "OMEN" and "b45" not in model and model["new"] == "ProBook"


def test_buckets_with_a_hot_key_are_read_without(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(published, "LARGE", 100)
    layout = Layout(str(tmp_path / "hot"), buckets=4)
    source = mapped_star(spark, "/root/testdata/sf0.001").tables()
    hot = source["FAIT_MISSION"].withColumn("ID_MISSION", F.lit("1"))
    publish(spark, layout, {**source, "FAIT_MISSION": hot}, ("init", "latest"))
    star = load_star(spark, layout)
    plan = star.fait_mission._jdf.queryExecution().executedPlan().toString()
    assert "sootledger_fait_mission" not in plan and star.fait_mission.count() == hot.count()
    assert "sootledger_dim_mission" in star.dim_mission._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deltas_do_not_depend_on_the_order_of_runs(spark, seed):
    """Random logs, loaded in random order with random re-runs, against one load of what is there in the end."""
    rng = random.Random(seed)
    columns, schema = ["pk", "v"], "ingest_date date, load_order long, pk string, v int"
    log, deltas = {}, spark.createDataFrame([], schema)
    for step in range(8):
        some = rng.sample(DAYS, rng.choice([1, 1, 2, 3]))
        for day in some:
            log[day] = [(day, i, f"k{rng.randrange(9)}", rng.randrange(4)) for i in range(rng.randrange(0, 7))]
        now = spark.createDataFrame([r for day in log.values() for r in day], schema)
        days = F.col("ingest_date").isin(some)
        written, other = loading.repaired_deltas(now, deltas, days, "pk", columns)
        fresh = [tuple(r) for r in written.select("ingest_date", "load_order", *columns).collect()]
        assert {r[0] for r in fresh} <= {*some, *other} and not set(some) & set(other)
        kept = [tuple(r) for r in deltas.collect() if r[0] not in {*some, *other}]
        deltas = spark.createDataFrame(kept + fresh, schema)
        want = loading.dim_delta(now, "pk", columns)
        assert rows(deltas, "ingest_date", "load_order", *columns) == rows(want, "ingest_date", "load_order", *columns)


def test_runs_in_any_order_equal_a_load_from_scratch(spark, drops, refs, tmp_path):
    drops.people("PARIS", [f"{PARIS};DRH;1990-03-01;2020-01-01 00:00:00"])
    drops.trips("PARIS", DAYS[0], [trip("m1", PARIS, DAYS[0]), trip("m2", PARIS, DAYS[0])])
    drops.trips("PARIS", DAYS[1], [trip("m1", PARIS, DAYS[1], "Schulung"), trip("m3", PARIS, DAYS[1])])
    drops.trips("PARIS", DAYS[2], [trip("m2", PARIS, DAYS[2]), trip("m4", PARIS, DAYS[2])])
    root = str(drops.root)
    again, scratch = Layout(str(tmp_path / "again")), Layout(str(tmp_path / "scratch"))
    for day in (DAYS[2], DAYS[0], DAYS[1]):
        runs.run_day(spark, again, root, refs, day)
    drops.trips("PARIS", DAYS[0], [trip("m4", PARIS, DAYS[0])])
    runs.run_day(spark, again, root, refs, DAYS[0])
    runs.run_range(spark, scratch, root, refs, DAYS[0], DAYS[2], labels=())
    for table in ("DIM_MISSION", "FAIT_MISSION"):
        columns = [*schemas.names(schemas.WAREHOUSE[table]), "ingest_date", "load_order"]
        assert rows(read_deltas(spark, again, table), *columns) == rows(read_deltas(spark, scratch, table), *columns)
    first = {r[0]: r[1] for r in rows(read_deltas(spark, again, "DIM_MISSION"), "ID_MISSION", "ingest_date")}
    assert first == {"m4": DAYS[0], "m1": DAYS[1], "m3": DAYS[1], "m2": DAYS[2]}


def test_first_sent_row_of_a_trip_survives_publishing(spark, drops, refs, tmp_path):
    """A trip sent again with an earlier date: the panel shows the row that came first."""
    drops.people("PARIS", [f"{PARIS};DRH;1990-03-01;2020-01-01 00:00:00"])
    early = dt.date(2026, 5, 20)
    drops.trips("PARIS", DAYS[1], [trip("m1", PARIS, DAYS[1])])
    drops.trips("PARIS", DAYS[3], [trip("m1", PARIS, early)])
    layout, root = Layout(str(tmp_path / "w")), str(drops.root)
    runs.initialise(spark, layout, root)
    runs.run_range(spark, layout, root, refs, DAYS[0], DAYS[5])
    trips = panels.trips_wide(load_star(spark, layout), sector=False)
    shown = panels.top_trips(trips).first()["jour"]
    by_day = panels.top_trips(trips, order=["DATE"]).first()["jour"]
    assert shown != by_day and trips.count() == 2
    [kept] = trips.where(F.col("DATE") == F.lit(DAYS[1])).select(panels.day_label("DATE").alias("d")).collect()
    assert shown == kept["d"]


def test_stream_sees_emptied_changed_and_removed_files(spark, drops, refs, tmp_path):
    drops.people("PARIS", [f"{PARIS};DRH;1990-03-01;2020-01-01 00:00:00"])
    for i, day in enumerate(DAYS[:4]):
        drops.goods("PARIS", day, [buy(f"b{i}", PARIS, day), buy("b9", PARIS, day)])
    drops.goods("BERLIN", DAYS[0], [buy("b5", "KeyPers_Berlin_2", DAYS[0])])
    streamed, scratch, root = Layout(str(tmp_path / "s")), Layout(str(tmp_path / "b")), str(drops.root)

    def stream():
        for q in start_ingest(spark, streamed, root, refs, str(tmp_path / "checkpoint")):
            q.awaitTermination(240)
            assert q.exception() is None

    stream()
    assert inventory(spark, streamed, "materiel").count() == 5
    drops.goods("PARIS", DAYS[0], [])  # only its header: b9 and b0 were first seen here
    drops.goods("PARIS", DAYS[1], [buy("b1", PARIS, DAYS[1], "Ecran", "OMEN")])
    [gone] = drops.root.rglob(f"MATERIEL_INFORMATIQUE_{DAYS[2]:%Y%m%d}.txt")
    gone.unlink()
    drops.goods("PARIS", DAYS[4], [buy("b2", PARIS, DAYS[4])])
    stream()
    days = Days(((DAYS[0], DAYS[5]),))
    runs.load_equipment(scratch, read_equipment_drops(spark, root), refs, days)
    runs.write_deltas(spark, scratch, "materiel", days)
    for table in ("DIM_MATERIEL", "FAIT_MATERIEL"):
        columns = [*schemas.names(schemas.WAREHOUSE[table]), "ingest_date"]
        assert rows(read_deltas(spark, streamed, table), *columns) == rows(read_deltas(spark, scratch, table), *columns)
    held = rows(inventory(spark, streamed, "materiel"), "ingest_date", "site_dir", "rows")
    assert held == [(DAYS[0], "BERLIN", 1), (DAYS[0], "PARIS", 0), (DAYS[1], "PARIS", 1), (DAYS[3], "PARIS", 2), (DAYS[4], "PARIS", 1)]
    # Nobody who reads the folders finds more than the rows.
    assert spark.read.parquet(streamed.log("materiel")).count() == 5
    assert synchronise(spark, streamed, root, refs, "materiel") == []
