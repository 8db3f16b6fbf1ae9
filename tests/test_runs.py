"""From drop files to the published warehouse: batch, day by day, and as a stream."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sootledger import schemas
from sootledger.plans import panels, quality, questions, runs
from sootledger.sinks import Layout, export_csv
from sootledger.sinks.ledger import MANIFEST, read_manifest
from sootledger.sources import (
    as_of,
    days_available,
    load_metadata,
    load_star,
    load_star_any,
    read_csv_table,
    read_equipment_drops,
    read_personnel_drops,
    read_trip_drops,
    read_trip_places,
    register_views,
    versions_available,
)
from sootledger.sources.drops import dedupe_file_rows
from sootledger.sources.warehouse import read_deltas, read_log
from sootledger.streaming.ingest import start_ingest
from tests.conftest import Drops, rows

D1, D2, D3 = (dt.date(2026, 6, d) for d in (1, 2, 5))


def trip(key, person, day, kind="Réunion", end="London;England", transport="Avion", back="oui", name="N"):
    return f"{key};{person};{name};P;{day} 18:13:03;{kind};Paris;France;{end};{transport};{back}"


def buy(key, person, day, kind="PC portable", model="ProBook "):
    return f"{key};{person};N;P;{day} 13:37:48;{kind};{model}"


def fill(drops):
    paris, la = "KeyPers_Paris_1", "KeyPers_LA_2"
    drops.people("PARIS", [f"{paris};Führungskraft;1980-03-01;2020-01-01 00:00:00",
                           f"{paris};DRH;1990-03-01;2020-01-01 00:00:00"])
    drops.people("LOSANGELES", [f"{la};Data Engineer;1985-07-15;2020-01-01 00:00:00"])
    drops.trips("PARIS", D1, [trip("m1", paris, D1), trip("m1", paris, D1),
                              trip("m2", paris, D1, "Konferenz", "Osaka;Japan"),
                              trip("m2", paris, D1, "Konferenz", "Osaka;Japan", name="M")])
    drops.trips("LOSANGELES", D2, [trip("m3", la, D2, "Schulung", "Paris;France"),
                                   trip("m1", paris, D2, "Formation")])
    drops.trips("PARIS", D3, [trip("m4", paris, D3, end="Atlantis;?", transport="Vélo")])
    drops.goods("PARIS", D1, [buy("b1", paris, D1), buy("b2", paris, D1, " ", "Modèle par défaut")])
    drops.goods("LOSANGELES", D1, [buy("b3", la, D1, "Ecran", "OMEN"), buy("b1", la, D1, model=" ")])
    drops.goods("LOSANGELES", D3, [buy("b4", la, D3, "PC portable", "Inconnu")])


@pytest.fixture(scope="module")
def refs(spark, reference_files):
    return runs.read_references(spark, reference_files)


@pytest.fixture(scope="module")
def delivered(tmp_path_factory):
    """Drop files that no test adds to."""
    drops = Drops(tmp_path_factory.mktemp("delivered"))
    fill(drops)
    return str(drops.root)


@pytest.fixture(scope="module")
def loaded(spark, delivered, refs, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("warehouse")))
    runs.initialise(spark, layout, delivered)
    runs.run_range(spark, layout, delivered, refs, D1, D3)
    return layout


def contents(star):
    return {
        t: rows(df, *schemas.names(schemas.WAREHOUSE[t])) for t, df in star.tables().items()
    }


def test_readers(spark, delivered):
    root = delivered
    trips = read_trip_drops(spark, root)
    assert rows(trips.groupBy("ingest_date", "site_dir").count()) == [
        (D1, "PARIS", 4), (D2, "LOSANGELES", 2), (D3, "PARIS", 1)]
    assert dedupe_file_rows(trips).count() == 6
    order = [r["ID_MISSION"] for r in trips.filter(F.col("ingest_date") == D1).orderBy("load_order").collect()]
    assert order == ["m1", "m1", "m2", "m2"]
    assert read_trip_drops(spark, root, D2, D2).count() == 2
    assert read_equipment_drops(spark, root).count() == 5
    assert read_personnel_drops(spark, root).count() == 3
    assert read_trip_places(spark, root).columns == ["VILLE_DEPART", "PAYS_DEPART", "VILLE_DESTINATION", "PAYS_DESTINATION"]


def test_only_listed_sites_are_read(spark, drops):
    drops.trips("PARIS", D1, [trip("m1", "P_Paris_1", D1)])
    drops.trips("TOKYO", D1, [trip("m2", "P_Tokyo_1", D1)])
    drops.people("TOKYO", ["P_Tokyo_1;Cadre;1980-01-01;2026-01-01"])
    root = str(drops.root)
    assert rows(read_trip_drops(spark, root), "ID_MISSION") == [("m1",)]
    assert rows(read_trip_drops(spark, root, sites=("TOKYO",)), "ID_MISSION") == [("m2",)]
    assert read_personnel_drops(spark, root).count() == 0


def test_readers_without_files(spark, tmp_path):
    root = str(tmp_path)
    assert read_trip_drops(spark, root).count() == 0
    assert read_personnel_drops(spark, root).count() == 0
    with pytest.raises(FileNotFoundError):
        read_trip_places(spark, root)


def test_other_layouts(spark, drops):
    header = "ID_MATERIELINFO;ID_PERSONNEL;DATE_ACHAT;TYPE"
    drops.goods("PARIS", D1, ["b1;KeyPers_Paris_1;2026-06-01 00:00:00;Ecran"], header=header)
    root = str(drops.root)
    with pytest.raises(Exception, match="(?i)header"):
        read_equipment_drops(spark, root).collect()
    df = read_equipment_drops(spark, root, header=header.split(";"))
    assert rows(df, "ID_MATERIELINFO", "TYPE") == [("b1", "Ecran")]


def test_published_tables(spark, loaded):
    got = contents(load_star(spark, loaded))
    assert got["DIM_PERSONNEL"] == [
        ("KeyPers_LA_2", "Ingénieur Data", "LA", dt.date(1985, 7, 15)),
        ("KeyPers_Paris_1", "Cadre", "Paris", dt.date(1980, 3, 1))]
    # The last row of b1 on its day is the Paris one: sites load in list order.
    assert got["DIM_MATERIEL"] == [
        ("b1", "PC portable", "ProBook", 210.0), ("b2", None, "Modèle par défaut", 350.0),
        ("b3", "Ecran", "OMEN", 150.0), ("b4", "PC portable", "Inconnu", None)]
    trips = {r[0]: r for r in got["DIM_MISSION"]}
    assert trips["m1"][1] == "Formation" and trips["m2"][1] == "Conférence"
    assert trips["m1"][8] == 344.2 and trips["m4"][8] is None
    assert trips["m2"][8] == pytest.approx(9656.61, abs=0.02)
    # m1 was sent on two days: two facts in the snapshot.
    assert [r[1] for r in got["FAIT_MISSION"]].count("m1") == 2
    assert [r[1] for r in got["FAIT_MATERIEL"]].count("b1") == 2


def test_deltas(spark, loaded):
    assert rows(days_available(spark, loaded)) == [(D1,), (D2,), (D3,)]
    second = load_star(spark, loaded, str(D2))
    assert rows(second.dim_mission, "ID_MISSION") == [("m3",)]
    assert rows(second.fait_mission, "ID_MISSION") == [("m1",), ("m3",)]
    assert second.fait_materiel.count() == 0
    assert second.dim_personnel.count() == 2
    assert load_star(spark, loaded, "2026-06-04").fait_mission.count() == 0
    with pytest.raises(FileNotFoundError):
        load_star(spark, loaded, "unknown")


def test_as_of(spark, loaded):
    first = as_of(spark, loaded, D1)
    assert {r[0]: r[1] for r in rows(first.dim_mission, "ID_MISSION", "TYPE_MISSION")} == {
        "m1": "Réunion", "m2": "Conférence"}
    assert contents(as_of(spark, loaded, D3)) == contents(load_star(spark, loaded))


def test_rerun_changes_nothing(spark, delivered, refs, loaded):
    before = contents(load_star(spark, loaded))
    days = {t: rows(read_deltas(spark, loaded, t)) for t in ("FAIT_MISSION", "DIM_MISSION")}
    assert runs.run_day(spark, loaded, delivered, refs, D2)
    assert not runs.run_day(spark, loaded, delivered, refs, dt.date(2026, 6, 3))
    runs.publish_snapshots(spark, loaded)
    assert contents(load_star(spark, loaded)) == before
    for t, old in days.items():
        assert rows(read_deltas(spark, loaded, t)) == old


def test_a_range_run_again_keeps_the_distances_it_had(spark, drops, refs, tmp_path):
    paris = "KeyPers_Paris_1"
    layout = Layout(str(tmp_path / "again"))
    drops.trips("PARIS", D1, [trip("m1", paris, D1, end="Osaka;Japan")])
    runs.run_range(spark, layout, str(drops.root), refs, D1, D3, labels=())
    drops.trips("PARIS", D3, [trip("m2", paris, D3, end="Paris;USA")])
    runs.run_range(spark, layout, str(drops.root), refs, D1, D3, labels=())
    distances = dict(rows(read_log(spark, layout, "mission"), "ID_MISSION", "DISTANCE_KM"))
    assert distances["m1"] == pytest.approx(9656.61, abs=0.02)
    assert distances["m2"] == pytest.approx(7801.64, abs=0.02)


def test_day_by_day_equals_one_pass(spark, delivered, refs, loaded, tmp_path):
    daily = Layout(str(tmp_path / "daily"))
    runs.initialise(spark, daily, delivered)
    for day in (D1, D2, D3):
        runs.run_day(spark, daily, delivered, refs, day)
    runs.publish_snapshots(spark, daily)
    assert contents(load_star(spark, daily)) == contents(load_star(spark, loaded))
    for t in ("FAIT_MISSION", "DIM_MISSION", "FAIT_MATERIEL", "DIM_MATERIEL"):
        assert rows(read_deltas(spark, daily, t)) == rows(read_deltas(spark, loaded, t))


def test_stream_equals_one_pass(spark, drops, refs, loaded, tmp_path):
    fill(drops)
    streamed = Layout(str(tmp_path / "streamed"))
    runs.initialise(spark, streamed, str(drops.root))
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):  # the second start finds nothing new
        for q in start_ingest(spark, streamed, str(drops.root), refs, checkpoint, max_files=2):
            q.awaitTermination(240)
            assert q.exception() is None
    runs.publish_snapshots(spark, streamed)
    assert contents(load_star(spark, streamed)) == contents(load_star(spark, loaded))
    late = dt.date(2026, 5, 31)
    drops.trips("BERLIN", late, [trip("m9", "KeyPers_Berlin_7", late)])
    for q in start_ingest(spark, streamed, str(drops.root), refs, checkpoint):
        q.awaitTermination(240)
    assert rows(load_star(spark, streamed, str(late)).dim_mission, "ID_MISSION") == [("m9",)]


def test_versions_and_metadata(spark, loaded):
    versions = [r[0] for r in versions_available(spark, loaded).collect()]
    assert versions == ["latest", "init", "final", str(D3), str(D2), str(D1)]
    [meta] = load_metadata(spark, loaded).collect()
    assert meta["source"] == "snapshot" and meta["day_folders"] == 3
    paths = {(r["label"], r["table"]): r["path"] for r in read_manifest(spark, loaded).collect()}
    assert paths[("latest", "DIM_PERSONNEL")] == paths[("init", "DIM_PERSONNEL")]


def test_rebuild_without_snapshot(spark, delivered, refs, tmp_path):
    layout = Layout(str(tmp_path / "days-only"))
    runs.initialise(spark, layout, delivered)
    runs.run_range(spark, layout, delivered, refs, D1, D3, labels=())
    star = load_star_any(spark, layout)
    # Facts are unique by key here, unlike in the snapshot.
    assert rows(star.fait_mission, "ID_MISSION", "ID_DATE_MISSION") == [
        ("m1", D2), ("m2", D1), ("m3", D2), ("m4", D3)]
    assert star.dim_personnel.count() == 2
    assert load_metadata(spark, layout).first()["source"] == "daily_folders"


def test_what_was_published_must_be_there(spark, delivered, refs, tmp_path):
    layout = Layout(str(tmp_path / "broken"))
    with pytest.raises(FileNotFoundError):  # no people yet
        runs.run_range(spark, layout, delivered, refs, D1, D1)
    runs.initialise(spark, layout, delivered)
    runs.publish_snapshots(spark, layout)
    paths = {r["table"]: r["path"] for r in read_manifest(spark, layout).where("label = 'latest'").collect()}
    assert load_star(spark, layout).fait_mission.count() > 0
    # A manifest row whose folder does not exist.
    lost = [("latest", 99, t, p + "-lost") for t, p in paths.items()]
    spark.createDataFrame(lost, MANIFEST).write.mode("append").json(layout.manifest)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_star(spark, layout)


def test_full_distance_build(spark, delivered, refs, tmp_path):
    layout = Layout(str(tmp_path / "distances-only"))
    runs.build_distances(spark, layout, delivered, refs.coordinates)
    runs.build_distances(spark, layout, delivered, refs.coordinates)
    known = runs.with_stored_distances(spark, layout, refs).distances
    assert rows(known, "VILLE_DESTINATION", "DISTANCE_KM") == [
        ("London", 343.92), ("Osaka", 9656.61), ("Paris", 8.0)]


def test_questions_and_panels_on_loaded_tables(spark, loaded):
    star = load_star(spark, loaded)
    register_views(star)
    [(tonnes,)] = spark.sql("""SELECT SUM(m.IMPACT) / 1000 FROM FAIT_MATERIEL f
        JOIN DIM_MATERIEL m ON f.ID_MATERIEL = m.ID_MATERIEL""").collect()
    assert tonnes == pytest.approx((2 * 210 + 350 + 150) / 1000)
    results = questions.run_questions(star, [*questions.QUESTIONS, "q99"])
    assert isinstance(results.pop("q99"), KeyError)
    values = {name: [tuple(r) for r in df.collect()] for name, df in results.items()}
    assert values["q1"] == [(1,)] and values["q2"] == [(1,)] and values["q3"] == [(0,)]
    assert values["q13"] == [(None,)]
    assert values["q15"][0][0] is None
    assert [r[-1] for r in values["q18"]][0] == "m2 (Conférence -> Osaka)"
    assert {r[1] for r in values["q20"]} == {"Missions", "Matériel Informatique"}

    again = questions.run_questions_on(spark, loaded, str(D1), ["q4"])
    assert rows(again["q4"]) == [(0,)]

    trips, goods = panels.analytical_frames(star, materialise=True)
    total = panels.kpis(trips, goods).first()["total"]
    per_site = sum(r["tCO2e"] for r in panels.by_site(trips, goods).collect())
    per_sector = sum(r["tCO2e"] for r in panels.by_sector(trips, goods, star.dim_personnel).collect())
    assert total == pytest.approx(per_site) == pytest.approx(per_sector)
    assert rows(panels.missing_impact(star)) == [(25.0, True)]
    assert rows(panels.filter_options(trips)["TRANSPORT"]) == [("Avion",), ("Vélo",)]
    matrix = panels.sector_site_matrix(trips, goods, star.dim_personnel)
    assert matrix.columns == ["FONCTION_PERSONNEL", "LA", "Paris"]
    assert [r[0] for r in matrix.collect()] == ["Ingénieur Data", "Cadre"]
    assert panels.kpis(trips.limit(0), goods.limit(0)).first()["total"] == 0.0
    assert rows(panels.date_range(trips, goods)) == [(D1, D3)]


def test_quality(spark, loaded):
    logs = {k: read_log(spark, loaded, k) for k in ("mission", "materiel")}
    report = quality.quality_report(logs)
    got = {(r["table_name"], r["ingest_date"], r["site_dir"]): r for r in report.collect()}
    assert got[("mission", D3, "PARIS")]["missing_DISTANCE_KM"] == 1
    assert got[("materiel", D3, "LOSANGELES")]["missing_impact_pct"] == 100.0
    assert got[("mission", D1, "PARIS")]["n_rows"] == 3
    assert quality.missing_columns({"t": (report, ["n_rows", "x"])}) == {"t": ["x"]}


def test_csv_export_and_import(spark, loaded, tmp_path):
    star = load_star(spark, loaded)
    path = f"{tmp_path}/csv/DIM_MISSION"
    export_csv(star.dim_mission.select(*schemas.names(schemas.DIM_MISSION)), path)
    back = read_csv_table(spark, path, "DIM_MISSION")
    assert rows(back) == contents(star)["DIM_MISSION"]
    empty = f"{tmp_path}/csv/empty"
    export_csv(spark.createDataFrame([], schemas.DIM_MATERIEL), empty)
    assert spark.read.text(empty).collect()[0][0] == "ID_MATERIEL,TYPE,MODELE,IMPACT"
    assert read_csv_table(spark, empty, "DIM_MATERIEL").count() == 0
    assert read_csv_table(spark, f"{tmp_path}/absent", "DIM_MATERIEL").count() == 0
    days = f"{tmp_path}/csv/days"
    export_csv(read_deltas(spark, loaded, "FAIT_MISSION").drop("load_order"), days, by_day=True)
    again = spark.read.option("header", True).csv(days)
    assert again.count() == 5 and "ingest_date" in again.columns


def test_rerun_equals_a_load_from_scratch(spark, drops, refs, tmp_path):
    paris, la = "KeyPers_Paris_1", "KeyPers_LA_2"
    drops.goods("PARIS", D1, [buy("b1", paris, D1)])
    drops.goods("LOSANGELES", D1, [buy("b2", la, D1)])
    drops.goods("PARIS", D2, [buy("b3", paris, D2)])
    drops.goods("PARIS", D3, [buy("b4", paris, D3)])
    drops.trips("PARIS", D2, [trip("m1", paris, D2)])
    again, scratch = Layout(str(tmp_path / "again")), Layout(str(tmp_path / "scratch"))
    root = str(drops.root)
    runs.run_range(spark, again, root, refs, D1, D3, labels=())
    drops.goods("PARIS", D1, [])  # only its header
    drops.goods("PARIS", D2, [buy("b2", la, D2)])  # no new key any more
    [gone] = [p for p in drops.root.rglob("*") if p.is_file() and "20260605" in p.name.replace("-", "").replace("_", "")]
    gone.unlink()
    for _ in range(2):
        runs.run_range(spark, again, root, refs, D1, D3, labels=())
    runs.run_range(spark, scratch, root, refs, D1, D3, labels=())
    for table in schemas.WAREHOUSE:
        if table == "DIM_PERSONNEL":
            continue
        columns = [*schemas.names(schemas.WAREHOUSE[table]), "ingest_date"]
        assert rows(read_deltas(spark, again, table), *columns) == rows(read_deltas(spark, scratch, table), *columns)
    assert read_log(spark, again, "materiel").count() == 2
    assert [r[0] for r in days_available(spark, again).collect()] == [D1, D2]
    assert not runs.run_day(spark, again, root, refs, D3)
