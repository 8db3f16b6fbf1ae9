import datetime as dt

import pytest
from pyspark.sql import functions as F

from sootledger import domain
from sootledger.plans import enrich
from sootledger.plans.runs import read_references
from sootledger.sources import read_distances, read_impacts, split_impacts
from tests.conftest import rows


@pytest.fixture(scope="module")
def refs(spark, reference_files):
    return read_references(spark, reference_files)


def test_impact_reference(spark, reference_files):
    by_model, by_type = split_impacts(read_impacts(spark, reference_files["impacts"]))
    assert rows(by_model) == [("OMEN", 150.0), ("ProBook", 210.0), ("Sans impact", None)]
    assert rows(by_type) == [("PC fixe sans ecran", 300.5), ("PC portable", 260.0)]


def test_absent_references_are_empty(spark, tmp_path):
    by_model, by_type = split_impacts(read_impacts(spark, f"{tmp_path}/none.csv"))
    assert by_model.count() == 0 and by_type.count() == 0
    assert read_distances(spark, f"{tmp_path}/none.csv").columns == [*domain.DISTANCE_KEYS, "DISTANCE_KM"]


def test_distances_keep_the_last_row_of_a_pair(refs):
    assert rows(refs.distances, "VILLE_DESTINATION", "DISTANCE_KM") == [("London", 344.2), ("Osaka", None)]


def test_factors(refs):
    got = {r["BAND"]: r["FACTOR"] for r in refs.bands.collect()}
    assert got == pytest.approx({
        "short_haul": 0.2586, "medium_haul": 0.1875, "long_haul": 0.152, "short_train": 0.0183,
        "long_train": 0.0024, "car": 0.25, "bus": 0.15})


def test_equipment_impact(spark, refs):
    cases = {
        ("PC portable", " "): 260.0,
        ("PC portable", None): 260.0,
        ("PC portable", "Modèle par défaut"): 260.0,
        (" ", "Modèle par défaut"): 350.0,
        (None, "modèle par défaut "): 350.0,
        (" ", " "): None,
        ("PC portable", "Inconnu"): None,
        ("Serveur", "ProBook "): 210.0,
        (" ", "OMEN"): 150.0,
        ("Imprimante", ""): None,
        ("Ecran", "Sans impact"): None,
    }
    df = spark.createDataFrame([(k, m, i) for i, (k, m) in enumerate(cases)],
                               "TYPE string, MODELE string, n int")
    out = enrich.equipment_impact(df, refs.by_model, refs.by_type)
    assert {r["n"]: r["IMPACT"] for r in out.collect()} == dict(enumerate(cases.values()))


def test_trip_impact(spark, refs):
    cases = [
        ("Avion", 999.99, "non", 0.2586, 258.5974),
        ("Avion", 1000.0, "oui", 0.1875, 375.0),
        ("plane", 3500.0, None, 0.1875, 656.25),
        ("Avion", 3500.01, "OUI", 0.152, 1064.003),
        ("Train", 200.0, "yes", 0.0183, 7.32),
        ("Train", 200.01, "non", 0.0024, 0.48),
        ("Taxi", 10.0, "non", 0.25, 2.5),
        ("Transports en commun", 10.0, "non", 0.15, 1.5),
        ("Vélo", 10.0, "non", None, None),
        ("Avion", None, "non", None, None),
    ]
    df = spark.createDataFrame(
        [(*c[:3], i) for i, c in enumerate(cases)],
        "TRANSPORT string, DISTANCE_KM double, ALLER_RETOUR string, n int")
    got = {r["n"]: r for r in enrich.trip_impact(df, refs.bands).collect()}
    for n, (*_, co2, impact) in enumerate(cases):
        assert got[n]["CO2EQ"] == pytest.approx(co2)
        assert got[n]["IMPACT"] == pytest.approx(impact, abs=1e-4)


PAIRS = "VILLE_DEPART string, PAYS_DEPART string, VILLE_DESTINATION string, PAYS_DESTINATION string"


def test_missing_distances(spark, refs):
    trips = spark.createDataFrame([
        ("Paris ", "France", "London", "England"),
        ("Paris", "France", "Osaka", "Japan"),
        ("Shanghai", "China", "Shanghai", "China"),
        ("Paris", "France", "Paris", "USA"),
        ("Paris", "France", "Atlantis", "?"),
    ], PAIRS)
    added = enrich.missing_distances(trips, refs.distances, refs.coordinates)
    got = {(r["VILLE_DEPART"], r["VILLE_DESTINATION"]): r["DISTANCE_KM"] for r in added.collect()}
    assert got[("Shanghai", "Shanghai")] == 8.0
    assert got[("Paris", "Osaka")] == pytest.approx(9669, abs=15)
    assert got[("Paris", "Paris")] > 7000
    assert len(got) == 3
    complete = enrich.complete_distances(refs.distances, added)
    located = enrich.add_distance(trips, complete)
    assert located.filter(F.col("DISTANCE_KM").isNull()).count() == 1
    assert located.count() == 5


def test_distance_reference_skips_unknown_places(spark, refs):
    trips = spark.createDataFrame([
        ("Paris", "France", "London", "England"), ("Paris ", "France", "London", "England"),
        ("Paris", "France", "Paris", "France"), ("Shanghai", "China", "Shanghai", "China"),
    ], PAIRS)
    out = enrich.distance_reference(trips, refs.coordinates)
    assert rows(out, "VILLE_DESTINATION", "DISTANCE_KM") == [("London", 343.92), ("Paris", 8.0)]
    assert rows(enrich.unlocated_places(trips, refs.coordinates)) == [("Shanghai", "China")]


def test_clean_trips_edge_rows(spark, refs):
    header = ("ID_MISSION string, ID_PERSONNEL string, NOM_PERSONNEL string, PRENOM_PERSONNEL string, "
              "DATE_MISSION string, TYPE_MISSION string, " + PAIRS +
              ", TRANSPORT string, ALLER_RETOUR string, ingest_date date, site_dir string, load_order bigint")
    day = dt.date(2026, 6, 1)
    trip = ("m1", "KeyPers_Paris_1", "N", "P", "2026-06-01 23:59:59", "Konferenz", "Paris", "France",
            "London", "England", "Avion", "oui", day, "PARIS")
    bad = ("m2", "sans site", "N", "P", "jamais", "Réunion", "Paris", "France", "Atlantis", "?", "Vélo",
           None, day, "PARIS")
    raw = spark.createDataFrame([(*trip, 1), (*trip, 2), (*bad, 3)], header)
    out = enrich.clean_trips(raw, refs.distances, refs.bands)
    assert "NOM_PERSONNEL" not in out.columns and "PRENOM_PERSONNEL" not in out.columns
    got = {r["ID_MISSION"]: r for r in out.collect()}
    assert len(got) == 2 and out.count() == 2
    assert got["m1"]["load_order"] == 1
    assert got["m1"]["TYPE_MISSION"] == "Conférence" and got["m1"]["ID_SITE"] == "Paris"
    assert got["m1"]["ID_DATE_MISSION"] == day
    assert got["m1"]["IMPACT"] == pytest.approx(344.2 * 0.2586 * 2, abs=1e-4)
    assert got["m2"]["ID_DATE_MISSION"] is None and got["m2"]["ID_SITE"] is None
    assert got["m2"]["IMPACT"] is None


def test_absent_column_is_reported_and_null(spark, refs, caplog):
    raw = spark.createDataFrame(
        [("b1", "KeyPers_LA_1", "2026-06-01 10:00:00", "ProBook", dt.date(2026, 6, 1), "LA", 1)],
        "ID_MATERIELINFO string, ID_PERSONNEL string, DATE_ACHAT string, MODELE string, "
        "ingest_date date, site_dir string, load_order bigint")
    out = enrich.clean_equipment(raw, refs.by_model, refs.by_type)
    assert rows(out, "ID_MATERIEL", "TYPE", "IMPACT", "ID_SITE") == [("b1", None, 210.0, "LA")]
    assert "TYPE" in caplog.text
