import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sootledger import functions as fn
from sootledger.functions.dates import file_name_of
from sootledger.functions.geo import WGS84_F, _opposite_km, inverse_geodesic
from tests.conftest import rows


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression).first()[0]


@pytest.mark.parametrize("text, expected", [
    (" a b ", "a b"), ("\t a\n", "a"), (" a\xa0", "a"), ("   ", ""), (None, None),
])
def test_strip(spark, text, expected):
    assert one(spark, text, fn.strip("c")) == expected


@pytest.mark.parametrize("text, expected", [
    ("modèle par défaut", True), (" Modèle Par Défaut ", True), ("modele par defaut", True),
    ("MODÈLE PAR DÉFAUT", True), ("ProBook", False), ("", False), (None, False),
])
def test_default_model(spark, text, expected):
    assert one(spark, text, fn.is_default_model("c")) is expected


@pytest.mark.parametrize("text, expected", [
    ("Konferenz", "Conférence"), ("Avion", "Avion"), ("", ""), (None, None), ("HRD", "DRH"),
])
def test_translation(spark, text, expected):
    assert one(spark, text, fn.translate_values("c")) == expected


@pytest.mark.parametrize("text, expected", [
    (" Avion ", "AVION"), ("PLANE", "AVION"), ("airplane", "AVION"), ("Train", "TRAIN"),
    ("Taxi", "TAXI"), ("Transports en commun", "TC"), ("public transport", "TC"), ("Vélo", None),
    (None, None),
])
def test_transport_code(spark, text, expected):
    assert one(spark, text, fn.transport_code("c")) == expected


@pytest.mark.parametrize("text, expected", [
    ("OUI", 2.0), ("yes", 2.0), ("non", 1.0), (None, 1.0), (" oui", 1.0),
])
def test_return_multiplier(spark, text, expected):
    assert one(spark, text, fn.return_multiplier("c")) == expected


@pytest.mark.parametrize("text, expected", [
    ("KeyPers_Berlin_12", "Berlin"), ("KeyPers", None), ("a_", ""), (None, None),
])
def test_site_of(spark, text, expected):
    assert one(spark, text, fn.site_of("c")) == expected


@pytest.mark.parametrize("text, expected", [
    ("2026-04-29 15:01:12", dt.date(2026, 4, 29)), ("2026-04-29", dt.date(2026, 4, 29)),
    ("2026-04-29T23:30:00-05:00", dt.date(2026, 4, 30)), ("29 avril", None), (None, None),
])
def test_to_day(spark, text, expected):
    assert one(spark, text, fn.to_day("c")) == expected


def test_file_names(spark):
    day = dt.date(2026, 6, 1)
    assert one(spark, day, file_name_of("MISSION", "c"), "date") == "MISSION_20260601.txt"
    assert one(spark, "MISSION_20260601.txt", fn.day_of_file("c")) == day
    assert one(spark, "MISSION_20261301.txt", fn.day_of_file("c")) is None
    assert one(spark, "LISEZMOI.txt", fn.day_of_file("c")) is None


def test_calendar(spark):
    days = rows(fn.day_calendar(spark, dt.date(2026, 2, 27), dt.date(2026, 3, 1)))
    assert days == [(dt.date(2026, 2, 27),), (dt.date(2026, 2, 28),), (dt.date(2026, 3, 1),)]
    assert fn.day_calendar(spark, dt.date(2026, 2, 2), dt.date(2026, 2, 1)).count() == 0


@pytest.mark.parametrize("text, expected", [("350", 350.0), (" 1.5 ", 1.5), ("x", None), ("", None)])
def test_to_number(spark, text, expected):
    assert one(spark, text, fn.to_number("c")) == expected


def test_half_even_is_the_array_rounding(spark):
    values = [0.125, 0.375, 2.5, -0.125, 12435.34965, 0.12345, 1e6 + 0.00005]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    for digits in (2, 4, 6):
        got = [r[0] for r in df.select(fn.half_even("c", digits)).collect()]
        assert got == [float(np.round(v, digits)) for v in values]


def test_texts(spark):
    assert one(spark, 1234.5, fn.thousands("c"), "double") == "1,234.50"
    assert one(spark, None, fn.day_label("c"), "date") == "?"
    assert one(spark, "  ", fn.label_missing("c")) == "Non renseigné"
    assert one(spark, "nan", fn.label_missing("c")) == "Non renseigné"
    assert one(spark, None, fn.route_label("c", F.lit("Paris"))) == "? → Paris"
    assert one(spark, "NA", fn.na_to_null("c")) is None
    assert one(spark, " ", fn.na_to_null("c")) == " "
    assert one(spark, None, fn.tonnes_or_zero("c"), "double") == 0.0
    assert fn.clean_name(" Modèle ", fold=True) == "MODELE"


def test_geodesic_known_points():
    # Published inverse solutions on WGS-84.
    flinders, buninyon = (-37.95103341666667, 144.42486788888889), (-37.652821138888886, 143.92649552777777)
    assert inverse_geodesic(*flinders, *buninyon) == pytest.approx(54.972271, abs=2e-6)
    # A degree of longitude on the equator, and a quarter meridian.
    assert inverse_geodesic(0, 0, 0, 1) == pytest.approx(111.319491, abs=1e-6)
    assert inverse_geodesic(0, 0, 90, 0) == pytest.approx(10001.965729, abs=1e-6)
    assert inverse_geodesic(48.0, 2.0, 48.0, 2.0) == pytest.approx(0.0, abs=1e-9)


def test_geodesic_arrays_and_opposite_points():
    lat1, lon1 = np.array([0.0, 10.0, 48.0]), np.array([0.0, 20.0, 179.9])
    lat2, lon2 = np.array([0.5, 11.0, 48.0]), np.array([179.7, 21.0, -179.9])
    km = inverse_geodesic(lat1, lon1, lat2, lon2)
    assert km[0] == pytest.approx(19944.127421, abs=1e-4)
    assert km[2] == pytest.approx(14.9, abs=0.1)
    assert inverse_geodesic(10.0, 20.0, 11.0, 21.0) == pytest.approx(km[1])
    # Exactly opposite points meet over a pole, and order and signs do not matter.
    assert inverse_geodesic(0, 0, 0, 180) == pytest.approx(20003.931459, abs=1e-4)
    assert inverse_geodesic(30, 10, -30, -170) == pytest.approx(20003.931459, abs=1e-4)
    ends = [(0.3, 0.0, 0.0, 179.6), (0.0, 179.6, 0.3, 0.0), (-0.3, 0.0, 0.0, -179.6)]
    assert len({round(float(inverse_geodesic(*e)), 6) for e in ends}) == 1


@pytest.mark.parametrize("ends", [(-30.0, 0.0, 29.0, 178.0), (10.0, 5.0, -9.0, 181.0), (1.0, 0.0, 2.0, 90.0)])
def test_bisection_agrees_with_iteration(ends):
    lat1, lon1, lat2, lon2 = map(np.array, ends)
    u1, u2 = (np.arctan((1 - WGS84_F) * np.tan(np.radians(x))) for x in (lat1, lat2))
    assert _opposite_km(u1, u2, np.radians(lon2 - lon1)) == pytest.approx(inverse_geodesic(*ends), abs=1e-3)


def test_distances_in_spark(spark):
    df = spark.createDataFrame([(48.8566, 2.3522, 51.5074, -0.1278), (0.0, 0.0, 0.5, 179.7),
                                (None, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    ends = [F.col(c) for c in "abcd"]
    got = df.select(fn.haversine_km(*ends), fn.geodesic_km(*ends)).collect()
    assert got[0][0] == pytest.approx(343.56, abs=0.05)
    assert got[0][1] == pytest.approx(343.92, abs=0.05)
    assert got[1][0] > 19000 and got[1][1] == pytest.approx(19944.13, abs=0.01)
    assert got[2][0] is None and got[2][1] is None
