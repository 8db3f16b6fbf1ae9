"""The test tables seen as footprint tables.

Each entry is (source table, {column: SQL expression}), every row is used. The
expressions are plain SQL that Spark and DuckDB read alike, so the registered
queries and their SQL counterparts start from the same rows: customers are
people, parts are equipment, line items are purchases, orders are trips.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sootledger.sources.warehouse import Star


def _case(value: str, *results: str, otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(results))
    return f"CASE {value} {whens} ELSE {otherwise or 'NULL'} END"


def _named(value: str, otherwise: str = "NULL", **results: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {r}" for k, r in results.items())
    return f"CASE {value} {whens} ELSE {otherwise} END"


def _pick(value: str, *words: str) -> str:
    """The value-th word, cut from one text of equally wide fields."""
    width = max(len(w) for w in words)
    line = "".join(w.ljust(width) for w in words)
    return f"trim(substr('{line}', CAST({value} AS INT) * {width} + 1, {width}))"


def site(key: str) -> str:
    return _pick(f"{key} % 6", "Berlin", "London", "LA", "NewYork", "Paris", "Shanghai")


def site_dir(key: str) -> str:
    return _pick(f"{key} % 6", "BERLIN", "LONDON", "LOSANGELES", "NEWYORK", "PARIS", "SHANGHAI")


def person(key: str) -> str:
    return f"'KeyPers_' || {site(key)} || '_' || CAST({key} AS STRING)"


def city(key: str) -> str:
    return _pick(
        key, "Berlin", "London", "Los Angeles", "New-York", "Paris", "Shanghai",
        *[f"NATION_{k}" for k in range(6, 25)],
    )


def country(key: str) -> str:
    return f"'REGION_' || CAST({key} % 5 AS STRING)"


_PRIORITY = "(ascii(o_orderpriority) - 49)"
_KIND = _pick(
    _PRIORITY, "Conférence", "Formation", "Réunion", "Rencontre entreprises", "Développement"
)
_SPELLED_KIND = _pick(
    f"({_PRIORITY} * 3 + o_orderkey % 3)",
    "Konferenz", "Conference", "Conférence", "Schulung", "Vocational Training", "Formation",
    "Meeting", "Team Meeting", "Réunion", "Geschäftstreffen", "Business Meeting",
    "Rencontre entreprises", "Entwicklung", "Development", "Développement",
)
_TYPE = _named(
    "p_type", ECONOMY="'PC portable'", LARGE="'PC fixe sans ecran'",
    MEDIUM="'PC fixe tout-en-un'", PROMO="'Ecran'", SMALL="'Serveur'",
)
_START, _END = "(o_custkey % 6)", "(o_orderkey % 25)"
_BUY_KEY = "CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING)"

TABLES: dict[str, tuple[str, dict[str, str]]] = {
    # ── warehouse ──
    "dim_personnel": ("customer", {
        "ID_PERSONNEL": person("c_custkey"),
        "FONCTION_PERSONNEL": _named(
            "c_mktsegment", AUTOMOBILE="'Ingénieur Data'", BUILDING="'Ingénieur Informaticien'",
            FURNITURE="'Cadre'", HOUSEHOLD="'Economiste'", MACHINERY="'DRH'"),
        "ID_SITE": site("c_custkey"),
        "DT_NAISS": "DATE '1955-01-01' + CAST((c_custkey * 37) % 16000 AS INT)",
    }),
    "fait_mission": ("orders", {
        "ID_PERSONNEL": f"CASE WHEN o_orderkey % 41 = 40 THEN 'KeyPers_Paris_inconnu' "
                        f"ELSE {person('o_custkey')} END",
        "ID_MISSION": "CAST(o_orderkey AS STRING)",
        "ID_SITE": site("o_custkey"),
        "ID_DATE_MISSION": "CAST(o_orderdate AS DATE)",
    }),
    "dim_mission": ("orders", {
        "ID_MISSION": "CAST(o_orderkey AS STRING)",
        "TYPE_MISSION": _KIND,
        "VILLE_DEPART": city(_START),
        "PAYS_DEPART": country(_START),
        "VILLE_DESTINATION": city(_END),
        "PAYS_DESTINATION": f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {country(_END)} END",
        "TRANSPORT": _named("o_orderstatus", F="'Avion'", O="'Train'"),
        "ALLER_RETOUR": "CASE WHEN o_orderkey % 2 = 0 THEN 'oui' ELSE 'non' END",
        "DISTANCE_KM": "CAST(100 * (o_orderkey % 60) AS DOUBLE)",
        "CO2EQ": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 7 AS DOUBLE) / 8 END",
        "IMPACT": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END",
    }),
    "fait_materiel": ("lineitem", {
        "ID_PERSONNEL": person("l_suppkey"),
        "ID_MATERIEL": "CASE WHEN l_quantity = 13 THEN 'perdu' ELSE CAST(l_partkey AS STRING) END",
        "ID_SITE": site("l_suppkey"),
        "ID_DATE_ACHAT": "CAST(l_shipdate AS DATE)",
    }),
    "dim_materiel": ("part", {
        "ID_MATERIEL": "CAST(p_partkey AS STRING)",
        "TYPE": _TYPE,
        "MODELE": "p_brand",
        "IMPACT": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_retailprice END",
    }),
    # ── raw drops, with the lineage their reader would add ──
    "raw_trips": ("orders", {
        "ID_MISSION": "CAST(o_orderkey AS STRING)",
        "ID_PERSONNEL": person("o_custkey"),
        "NOM_PERSONNEL": "'Name' || CAST(o_custkey AS STRING)",
        "PRENOM_PERSONNEL": "'First' || CAST(o_custkey AS STRING)",
        "DATE_MISSION": "CASE WHEN o_orderkey % 97 = 0 THEN 'sans date' "
                        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 18:13:03' END",
        "TYPE_MISSION": _SPELLED_KIND,
        "VILLE_DEPART": f"CASE WHEN o_orderkey % 7 = 0 THEN ({city(_START)}) || ' ' "
                        f"ELSE {city(_START)} END",
        "PAYS_DEPART": country(_START),
        "VILLE_DESTINATION": city(_END),
        "PAYS_DESTINATION": country(_END),
        "TRANSPORT": _named(
            "o_orderstatus",
            F="CASE WHEN o_orderkey % 2 = 0 THEN 'Avion' ELSE ' plane ' END", O="'Train'",
            P=_case("CAST(o_orderkey % 4 AS INT)", "'Taxi'", "'Public transport'", "'Vélo'")),
        "ALLER_RETOUR": _case("CAST(o_orderkey % 4 AS INT)", "'oui'", "'YES'", "'non'"),
        "ingest_date": "CAST(o_orderdate AS DATE)",
        "site_dir": site_dir("o_custkey"),
        "load_order": "o_orderkey",
    }),
    "raw_equipment": ("lineitem", {
        "ID_MATERIELINFO": _BUY_KEY,
        "ID_PERSONNEL": person("l_suppkey"),
        "NOM_PERSONNEL": "'Name' || CAST(l_suppkey AS STRING)",
        "PRENOM_PERSONNEL": "'First' || CAST(l_suppkey AS STRING)",
        "DATE_ACHAT": "CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 13:37:48'",
        "TYPE": _case("CAST(l_partkey % 8 AS INT)", "' '", "'PC portable'", "'PC fixe sans ecran '",
                      "'PC fixe tout-en-un'", "'Ecran'", "'Serveur'", "NULL", "'imprimante'"),
        "MODELE": _case("CAST(l_suppkey % 5 AS INT)", "' '", "'Modèle par défaut'",
                        otherwise="'Brand#' || CAST(l_partkey % 27 AS STRING) || ' '"),
        "ingest_date": "CAST(l_shipdate AS DATE)",
        "site_dir": site_dir("l_suppkey"),
        "load_order": "l_partkey * 1000000 + l_suppkey",
    }),
    "raw_personnel": ("customer", {
        "ID_PERSONNEL": person("(c_custkey % 1200)"),
        "FONCTION_PERSONNEL": _named(
            "c_mktsegment", AUTOMOBILE="'Dateningenieur'", BUILDING="'Computer Engineer'",
            FURNITURE="'Führungskraft'", HOUSEHOLD="'Economiste'", MACHINERY="'HRD'"),
        "DT_NAISS": "CAST(DATE '1955-01-01' + CAST((c_custkey * 37) % 16000 AS INT) AS STRING)",
        "TS_CREATION_PERSONNEL": "'2020-01-01 00:00:00'",
        "site_dir": site_dir("c_custkey"),
        "load_order": "c_custkey",
    }),
    # ── reference tables ──
    "impacts": ("part", {
        "TYPE": f"CASE WHEN p_type = 'STANDARD' THEN ' ' ELSE {_TYPE} END",
        "MODELE": "CASE WHEN p_size % 10 = 0 THEN 'Modèle par défaut' ELSE p_brand || ' ' END",
        "IMPACT": "CAST(p_retailprice AS STRING)",
        "_position": "p_partkey",
    }),
    "transports": ("part", {
        "subcategory": "CASE WHEN p_type = 'ECONOMY' THEN 'Bus' ELSE p_type END",
        "subsubcategory": "CASE p_size WHEN 1 THEN 'Plane - Short haul' "
                          "WHEN 2 THEN 'Plane - Medium haul' WHEN 3 THEN 'Plane - Long haul' "
                          "WHEN 4 THEN 'Train < 200 km' WHEN 5 THEN 'TGV > 200 km' "
                          "WHEN 6 THEN NULL ELSE p_name END",
        "total": "CAST(p_retailprice / 10000 AS STRING)",
        "_position": "p_partkey",
    }),
    "cars": ("part", {
        "subcategory": "CASE WHEN p_type = 'LARGE' THEN 'Car' ELSE p_type END",
        "total": "CAST(p_retailprice / 5000 AS STRING)",
        "_position": "p_partkey",
    }),
    "coordinates": ("nation", {
        "VILLE": f"CASE WHEN n_nationkey = 17 THEN 'Nulle part' ELSE {city('n_nationkey')} END",
        "PAYS": country("n_nationkey"),
        "LAT": "CAST((n_nationkey * 7) % 120 - 60 AS DOUBLE)",
        "LON": "CAST((n_nationkey * 29) % 360 - 180 AS DOUBLE)",
    }),
    # A third of the pairs that trips use already have a distance.
    "known_distances": ("orders", {
        "VILLE_DEPART": city(_START),
        "PAYS_DEPART": country(_START),
        "VILLE_DESTINATION": city(_END),
        "PAYS_DESTINATION": country(_END),
        "DISTANCE_KM": f"CASE WHEN ({_START} + {_END}) % 3 = 0 "
                       f"THEN CAST(100 * ({_START} + {_END}) AS DOUBLE) END",
    }),
    # ── events as a log of days ──
    "event_log": ("events", {
        "ingest_date": "CAST(ts AS DATE)",
        "load_order": "event_id",
        "user_id": "user_id",
        "event_type": "event_type",
        "value": "value",
    }),
}


@cache
def _schema(path: str) -> T.StructType:
    """Schema of a test table, looked up once so that later reads need no footer job."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = TABLES[name]
    df = table(spark, sf_dir, source)
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def star(spark: SparkSession, sf_dir: str) -> Star:
    names = ("fait_mission", "fait_materiel", "dim_personnel", "dim_materiel", "dim_mission")
    return Star(**{n: frame(spark, sf_dir, n) for n in names})


def sql_views(*names: str) -> str:
    """The same frames as common table expressions, without the WITH keyword."""
    parts = []
    for name in names:
        source, columns = TABLES[name]
        listed = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
        parts.append(f"{name} AS (SELECT {listed} FROM {source})")
    return ",\n".join(parts)
