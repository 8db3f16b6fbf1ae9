"""Explicit schemas of drop files, reference tables and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _mixed(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _D, _DAY = T.StringType(), T.DoubleType(), T.DateType()

# Drop files: every column is text, parsed explicitly later.
RAW_TRIP = _text(
    "ID_MISSION", "ID_PERSONNEL", "NOM_PERSONNEL", "PRENOM_PERSONNEL", "DATE_MISSION",
    "TYPE_MISSION", "VILLE_DEPART", "PAYS_DEPART", "VILLE_DESTINATION", "PAYS_DESTINATION",
    "TRANSPORT", "ALLER_RETOUR",
)
RAW_EQUIPMENT = _text(
    "ID_MATERIELINFO", "ID_PERSONNEL", "NOM_PERSONNEL", "PRENOM_PERSONNEL", "DATE_ACHAT",
    "TYPE", "MODELE",
)
RAW_PERSONNEL = _text("ID_PERSONNEL", "FONCTION_PERSONNEL", "DT_NAISS", "TS_CREATION_PERSONNEL")

# Reference tables.
IMPACT_REFERENCE = _text("TYPE", "MODELE", "IMPACT")
DISTANCE_REFERENCE = _mixed(
    ("VILLE_DEPART", _S), ("PAYS_DEPART", _S), ("VILLE_DESTINATION", _S),
    ("PAYS_DESTINATION", _S), ("DISTANCE_KM", _D),
)
CITY_COORDINATES = _mixed(("VILLE", _S), ("PAYS", _S), ("LAT", _D), ("LON", _D))
BAND_FACTORS = _mixed(
    ("BAND", _S), ("CODE", _S), ("LO", _D), ("LO_IN", T.BooleanType()),
    ("HI", _D), ("HI_IN", T.BooleanType()), ("FACTOR", _D),
)

# Warehouse.
FAIT_MISSION = _mixed(
    ("ID_PERSONNEL", _S), ("ID_MISSION", _S), ("ID_SITE", _S), ("ID_DATE_MISSION", _DAY)
)
FAIT_MATERIEL = _mixed(
    ("ID_PERSONNEL", _S), ("ID_MATERIEL", _S), ("ID_SITE", _S), ("ID_DATE_ACHAT", _DAY)
)
DIM_PERSONNEL = _mixed(
    ("ID_PERSONNEL", _S), ("FONCTION_PERSONNEL", _S), ("ID_SITE", _S), ("DT_NAISS", _DAY)
)
DIM_MATERIEL = _mixed(("ID_MATERIEL", _S), ("TYPE", _S), ("MODELE", _S), ("IMPACT", _D))
DIM_MISSION = _mixed(
    ("ID_MISSION", _S), ("TYPE_MISSION", _S), ("VILLE_DEPART", _S), ("PAYS_DEPART", _S),
    ("VILLE_DESTINATION", _S), ("PAYS_DESTINATION", _S), ("TRANSPORT", _S), ("ALLER_RETOUR", _S),
    ("DISTANCE_KM", _D), ("CO2EQ", _D), ("IMPACT", _D),
)

WAREHOUSE = {
    "FAIT_MISSION": FAIT_MISSION,
    "FAIT_MATERIEL": FAIT_MATERIEL,
    "DIM_PERSONNEL": DIM_PERSONNEL,
    "DIM_MATERIEL": DIM_MATERIEL,
    "DIM_MISSION": DIM_MISSION,
}
PRIMARY_KEY = {
    "FAIT_MISSION": "ID_MISSION",
    "FAIT_MATERIEL": "ID_MATERIEL",
    "DIM_PERSONNEL": "ID_PERSONNEL",
    "DIM_MATERIEL": "ID_MATERIEL",
    "DIM_MISSION": "ID_MISSION",
}
DATE_COLUMN = {"FAIT_MISSION": "ID_DATE_MISSION", "FAIT_MATERIEL": "ID_DATE_ACHAT"}

# Lower-case copies stored beside these columns so that case-insensitive
# equality reaches the Parquet statistics as a plain comparison.
KEYED_COLUMNS = {
    "FAIT_MISSION": ["ID_SITE"],
    "FAIT_MATERIEL": ["ID_SITE"],
    "DIM_PERSONNEL": ["FONCTION_PERSONNEL", "ID_SITE"],
    "DIM_MATERIEL": ["TYPE"],
    "DIM_MISSION": ["TYPE_MISSION", "TRANSPORT", "VILLE_DESTINATION"],
}

# Where a row came from: the day and site of its drop file, and its place in the day.
LINEAGE = ["ingest_date", "site_dir", "load_order"]


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
