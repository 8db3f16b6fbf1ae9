"""Cleaning and enrichment of the drops: impact rules, distances, transport factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sootledger import domain, schemas
from sootledger.functions.dates import to_day
from sootledger.functions.geo import geodesic_km, haversine_km
from sootledger.functions.numbers import half_even, to_number
from sootledger.functions.text import (
    blank_to_null,
    clean_name,
    is_default_model,
    return_multiplier,
    site_of,
    strip,
    translate_values,
    transport_code,
)
from sootledger.operators.contract import as_null, clean_header, keep_columns, rename
from sootledger.operators.joins import (
    append_reference,
    band_lookup,
    lookup,
    lookup_or_compute,
    with_both_ends,
)
from sootledger.operators.ranking import first_per_key
from sootledger.operators.sets import distinct_places
from sootledger.sources.drops import dedupe_file_rows

ENDS = [("VILLE_DEPART", "PAYS_DEPART"), ("VILLE_DESTINATION", "PAYS_DESTINATION")]


def _kept(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct file rows with the kept columns; an absent one is reported and NULL."""
    raw = clean_header(raw)
    rows = dedupe_file_rows(raw, [clean_name(c) for c in columns])
    df, missing = keep_columns(rows, columns, schemas.LINEAGE)
    return as_null(df, missing)


# ── Equipment ────────────────────────────────────────────────────────────────


def equipment_impact(df: DataFrame, by_model: DataFrame, by_type: DataFrame) -> DataFrame:
    """IMPACT from TYPE and MODELE.

    No type and the default model: a constant. No model or the default model:
    the type's default row, where no type is a type too. Otherwise the model's row, whatever the type, and
    NULL when the model is unknown. MODELE and TYPE come out trimmed.
    """
    df = df.withColumns({"MODELE": blank_to_null("MODELE"), "TYPE": blank_to_null("TYPE")})
    df = lookup(df, by_model.withColumnRenamed("IMPACT", "_by_model"), "MODELE")
    df = df.withColumn("_type", F.coalesce("TYPE", F.lit("")))
    df = lookup(df, by_type.select(F.col("TYPE").alias("_type"), F.col("IMPACT").alias("_by_type")), "_type")
    no_type, no_model = F.col("TYPE").isNull(), F.col("MODELE").isNull()
    default = is_default_model("MODELE")
    impact = (
        F.when(no_model, F.col("_by_type"))
        .when(~default, F.col("_by_model"))
        .when(no_type, F.lit(domain.UNTYPED_DEFAULT_IMPACT))
        .otherwise(F.col("_by_type"))
    )
    return df.withColumn("IMPACT", impact).drop("_by_model", "_by_type", "_type")


def clean_equipment(raw: DataFrame, by_model: DataFrame, by_type: DataFrame) -> DataFrame:
    """Raw equipment rows with lineage to rows of FAIT_MATERIEL plus DIM_MATERIEL."""
    df = _kept(raw, domain.EQUIPMENT_COLUMNS)
    df = df.withColumn("DATE_ACHAT", to_day("DATE_ACHAT"))
    df = rename(df, {"DATE_ACHAT": "ID_DATE_ACHAT", "ID_MATERIELINFO": "ID_MATERIEL"})
    df = df.withColumn("ID_SITE", site_of("ID_PERSONNEL"))
    return equipment_impact(df, by_model, by_type)


# ── Trips ────────────────────────────────────────────────────────────────────


def trip_impact(df: DataFrame, bands: DataFrame) -> DataFrame:
    """CO2EQ in kg per km of the trip's band and IMPACT in kg, counted twice for a return."""
    df = df.withColumn("_code", transport_code("TRANSPORT"))
    df = df.withColumn("_km", to_number("DISTANCE_KM"))
    df = band_lookup(df, bands, "_code", "_km")
    df = df.withColumn("CO2EQ", half_even("FACTOR", 6))
    impact = F.col("_km") * F.col("CO2EQ") * return_multiplier("ALLER_RETOUR")
    df = df.withColumn("IMPACT", half_even(impact, 4))
    return df.drop("_code", "_km", "BAND", "LO", "LO_IN", "HI", "HI_IN", "FACTOR")


def _same_place():
    return (F.col("VILLE_DEPART") == F.col("VILLE_DESTINATION")) & (
        F.col("PAYS_DEPART") == F.col("PAYS_DESTINATION")
    )


def pair_distance(ellipsoid: bool = True):
    """Column of the distance between the two ends of a row that has LAT_1 … LON_2."""
    ends = [F.col(c) for c in ("LAT_1", "LON_1", "LAT_2", "LON_2")]
    km = geodesic_km(*ends) if ellipsoid else haversine_km(*ends)
    return F.when(_same_place(), F.lit(domain.SAME_CITY_KM)).otherwise(F.round(km, 2))


def distance_of_pairs(pairs: DataFrame, coordinates: DataFrame, ellipsoid: bool = True):
    """DISTANCE_KM per pair: a constant within a city, NULL for an unknown city."""
    placed = with_both_ends(pairs, coordinates, ENDS, how="left")
    return placed.select(*domain.DISTANCE_KEYS, pair_distance(ellipsoid).alias("DISTANCE_KM"))


def missing_distances(
    trips: DataFrame, distances: DataFrame, coordinates: DataFrame, ellipsoid: bool = True
) -> DataFrame:
    """Reference rows for the trips' pairs that have no distance yet."""
    keys = trips.select(*[strip(c).alias(c) for c in domain.DISTANCE_KEYS])
    _, added = lookup_or_compute(
        keys, distances, domain.DISTANCE_KEYS, "DISTANCE_KM",
        lambda missing: distance_of_pairs(missing, coordinates, ellipsoid),
    )
    return added


def complete_distances(distances: DataFrame, added: DataFrame) -> DataFrame:
    return append_reference(distances, added, domain.DISTANCE_KEYS)


def add_distance(trips: DataFrame, distances: DataFrame) -> DataFrame:
    """DISTANCE_KM by the four place columns, trimmed on the way."""
    trips = trips.withColumns({c: strip(c) for c in domain.DISTANCE_KEYS})
    return lookup(trips, distances, domain.DISTANCE_KEYS)


def distinct_trip_rows(raw: DataFrame) -> DataFrame:
    """Distinct file rows of trips with the columns that go on."""
    return _kept(raw, domain.TRIP_COLUMNS)


def clean_trips(raw: DataFrame, distances: DataFrame, bands: DataFrame) -> DataFrame:
    """Raw trip rows with lineage to rows of FAIT_MISSION plus DIM_MISSION."""
    return clean_trip_rows(distinct_trip_rows(raw), distances, bands)


def clean_trip_rows(df: DataFrame, distances: DataFrame, bands: DataFrame) -> DataFrame:
    """Distinct trip rows to rows of FAIT_MISSION plus DIM_MISSION."""
    df = df.withColumns({c: translate_values(c) for c in ("TYPE_MISSION", "TRANSPORT")})
    df = df.withColumn("DATE_MISSION", to_day("DATE_MISSION"))
    df = trip_impact(add_distance(df, distances), bands)
    df = rename(df, {"DATE_MISSION": "ID_DATE_MISSION"})
    return df.withColumn("ID_SITE", site_of("ID_PERSONNEL"))


def distance_reference(
    trips: DataFrame, coordinates: DataFrame, ellipsoid: bool = True
) -> DataFrame:
    """Distances of every distinct pair of trips whose two places are known."""
    pairs = trips.select(*[strip(c).alias(c) for c in domain.DISTANCE_KEYS]).distinct()
    placed = with_both_ends(pairs, coordinates, ENDS, how="inner")
    return placed.select(*domain.DISTANCE_KEYS, pair_distance(ellipsoid).alias("DISTANCE_KM"))


def unlocated_places(trips: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Places of the trips without coordinates."""
    places = trips.select(*[strip(c).alias(c) for c in domain.DISTANCE_KEYS])
    return distinct_places(places).join(
        coordinates.select("VILLE", "PAYS"), on=["VILLE", "PAYS"], how="left_anti"
    )


# ── Personnel ────────────────────────────────────────────────────────────────


def personnel_dimension(raw: DataFrame) -> DataFrame:
    """Raw personnel rows with lineage to DIM_PERSONNEL; the first row of an id counts."""
    df = _kept(raw, domain.PERSONNEL_COLUMNS)
    df = df.withColumn("FONCTION_PERSONNEL", translate_values("FONCTION_PERSONNEL"))
    df = df.withColumn("ID_SITE", site_of("ID_PERSONNEL"))
    df = df.withColumn("DT_NAISS", to_day("DT_NAISS"))
    df = first_per_key(df, "ID_PERSONNEL", ["load_order"])
    return df.select(*schemas.names(schemas.DIM_PERSONNEL))
