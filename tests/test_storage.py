"""Addressed reading, folded distances, narrow de-duplication."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sootledger import domain, schemas
from sootledger.plans import enrich, runs
from sootledger.sinks import Layout, ledger
from sootledger.sources import drops as reading
from sootledger.sources import read_equipment_drops, read_trip_drops, read_trip_places
from tests.conftest import rows
from tests.test_runs import buy, trip

DAYS = [dt.date(2026, 6, d) for d in range(1, 13)]
PARIS = "KeyPers_Paris_1"


@pytest.fixture
def refs(spark, reference_files):
    return runs.read_references(spark, reference_files)


def test_few_days_are_asked_for_by_name(spark, drops):
    for day in DAYS:
        drops.trips("PARIS", day, [trip(f"m{day.day}", PARIS, day)])
        drops.trips("TOKYO", day, [trip(f"t{day.day}", PARIS, day)])
        drops.goods("LOSANGELES", day, [buy(f"b{day.day}", PARIS, day)])
    root = str(drops.root)
    one = read_trip_drops(spark, root, DAYS[3], DAYS[3])
    assert len(one.inputFiles()) == 1 and rows(one, "ID_MISSION") == [("m4",)]
    whole = rows(read_trip_drops(spark, root).filter(F.col("ingest_date").between(DAYS[2], DAYS[5])).drop("load_order"))
    assert rows(read_trip_drops(spark, root, DAYS[2], DAYS[5]).drop("load_order")) == whole and len(whole) == 4
    assert read_trip_drops(spark, root, DAYS[0], DAYS[-1]).count() == 12  # lists the tree
    named = read_equipment_drops(spark, root, days=[DAYS[1], DAYS[9]])
    assert len(named.inputFiles()) == 2 and named.count() == 2
    assert read_trip_drops(spark, root, dt.date(2027, 1, 1), dt.date(2027, 1, 1)).count() == 0
    assert read_trip_drops(spark, f"{root}/absent", DAYS[0], DAYS[0]).count() == 0
    # Daily folders are found whatever lies above them, and are not listed.
    found = reading.addressed(spark, root, reading.TRIP_GLOB, [DAYS[0]], domain.SITE_CODES)
    assert [f.rsplit("/", 2)[1] for f in found] == ["DATA_PARIS_MISSION"]


def test_a_file_with_only_its_header_is_a_file(spark, drops):
    drops.trips("PARIS", DAYS[0], [])
    assert read_trip_places(spark, str(drops.root)).count() == 0


def test_distances_are_folded(spark, drops, refs, tmp_path):
    """The number of files does not grow with the loads; the newest row of a pair counts."""
    layout = Layout(str(tmp_path / "w"))
    schema = "VILLE_DEPART string, PAYS_DEPART string, VILLE_DESTINATION string, PAYS_DESTINATION string, DISTANCE_KM double"

    def pair(city, km):
        return spark.createDataFrame([("Paris", "France", city, "X", km)], schema)

    for i in range(4):
        stored = ledger.append_distances(pair(f"c{i % 3}", float(i)), layout, f"load{i}")
        assert rows(stored, "VILLE_DESTINATION", "DISTANCE_KM") == [(f"c{i % 3}", float(i))]
    known = lambda: rows(runs.with_stored_distances(spark, layout, refs).distances, "VILLE_DESTINATION", "DISTANCE_KM")
    before = known()
    assert ("c0", 3.0) in before and ("London", 344.2) in before
    assert not ledger.fold_distances(spark, layout, least=5)
    for k in range(3):
        assert ledger.fold_distances(spark, layout, least=1)
        assert known() == before
        assert ledger.added_distances(spark, layout).count() == 0
        ledger.append_distances(pair("c1", 50.0 + k), layout, "again")
        before = sorted([r for r in before if r[0] != "c1"] + [("c1", 50.0 + k)], key=str)
        assert sorted(known(), key=str) == before
    kept = {p.name for p in (tmp_path / "w" / "distances_folded").iterdir()}
    assert kept == {"pointer", "v=2", "v=3"}


def test_names_do_not_go_through_the_shuffle(spark):
    fields = [*schemas.names(schemas.RAW_EQUIPMENT), "ingest_date", "site_dir", "load_order"]
    data = [
        ("b", "p", "N", "P", "d", "t", "m", "x", "s", 3), ("b", "p", "N", "P", "d", "t", "m", "x", "s", 1),
        ("b", "p", "M", "P", "d", "t", "m", "x", "s", 2), ("b", "p", None, "P", "d", "t", "m", "x", "s", 4),
        ("b", "p", "", "P", "d", "t", "m", "x", "s", 5), ("b", "p", "N", "P", "d", "t", "m", "x", "other", 6)]
    raw = spark.createDataFrame(data, fields)
    out = reading.dedupe_file_rows(raw, domain.EQUIPMENT_COLUMNS)
    assert sorted(r["load_order"] for r in out.collect()) == [1, 2, 4, 5, 6]
    assert sorted(r["load_order"] for r in enrich._kept(raw, domain.EQUIPMENT_COLUMNS).collect()) == [1, 2, 4, 5, 6]
    plan = enrich._kept(raw, domain.EQUIPMENT_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not any("NOM_PERSONNEL" in line for line in shuffled)


def test_text_is_parsed_once(spark, drops, refs, tmp_path, monkeypatch):
    """Distances and cleaning read what one scan of the files landed; the landing goes with the load."""
    drops.trips("PARIS", DAYS[0], [trip("m1", PARIS, DAYS[0]), trip("m1", PARIS, DAYS[0])])
    layout, seen = Layout(str(tmp_path / "w")), []

    def watch(name):
        f = getattr(runs, name)

        def run(rows, *rest):
            seen.append((name, rows._jdf.queryExecution().executedPlan().toString(), rows.count()))
            return f(rows, *rest)

        monkeypatch.setattr(runs, name, run)

    watch("missing_distances")
    watch("clean_trip_rows")
    runs.run_day(spark, layout, str(drops.root), refs, DAYS[0])
    assert [name for name, _, _ in seen] == ["missing_distances", "clean_trip_rows"]
    assert all("FileScan parquet" in plan and "csv" not in plan and n == 1 for _, plan, n in seen)
    assert not any((tmp_path / "w" / "landing").iterdir())
