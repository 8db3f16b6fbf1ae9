"""Reference tables: equipment impacts, city distances, transport factors, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sootledger import domain, schemas
from sootledger.functions.numbers import to_number
from sootledger.functions.text import (
    blank_to_null,
    contains_text,
    is_default_model,
    na_to_null,
    strip,
)
from sootledger.operators.contract import clean_header
from sootledger.operators.ranking import first_per_key, last_per_key
from sootledger.files import or_empty, read_delimited, row_position


def _with_position(df: DataFrame) -> DataFrame:
    return df.withColumn("_position", row_position(F.col("_metadata.file_block_start")))


def read_impacts(spark: SparkSession, path: str) -> DataFrame:
    """Impact per TYPE and MODELE as read, with the row's place; empty when absent."""
    schema = T.StructType(list(schemas.IMPACT_REFERENCE.fields)).add("_position", "long")
    return or_empty(
        spark, lambda: clean_header(_with_position(read_delimited(spark, path, ",")), fold=True)
        .withColumnRenamed("_POSITION", "_position"), schema
    )


def split_impacts(reference: DataFrame, position: str = "_position") -> tuple[DataFrame, DataFrame]:
    """(impact per MODELE, default impact per TYPE); the first row of a key counts.

    A blank TYPE is a type of its own, written as the empty text; an absent cell is none.
    """
    ref = reference.select(
        blank_to_null("MODELE").alias("MODELE"),
        strip("TYPE").alias("TYPE"),
        to_number("IMPACT").alias("IMPACT"),
        F.col(position),
    )
    default = is_default_model("MODELE")
    by_type = ref.filter(default & F.col("TYPE").isNotNull()).select("TYPE", "IMPACT", position)
    by_model = ref.filter(~default & F.col("MODELE").isNotNull()).select(
        "MODELE", "IMPACT", position
    )
    return (
        first_per_key(by_model, "MODELE", [position]).drop(position),
        first_per_key(by_type, "TYPE", [position]).drop(position),
    )


def clean_distances(df: DataFrame, position: str | None = None) -> DataFrame:
    """Trimmed keys, numeric distance; a key given twice keeps its last row."""
    keys = [strip(c).alias(c) for c in domain.DISTANCE_KEYS]
    extra = [position] if position else []
    out = df.select(*keys, to_number("DISTANCE_KM").alias("DISTANCE_KM"), *extra)
    if position:
        out = last_per_key(out, domain.DISTANCE_KEYS, [position]).drop(position)
    return out


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """City-pair distances from a ``;`` file; empty with schema when absent."""

    def read():
        df = _with_position(clean_header(read_delimited(spark, path, ";")))
        return clean_distances(df, "_position")

    return or_empty(spark, read, schemas.DISTANCE_REFERENCE)


def read_coordinates(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """City coordinates VILLE, PAYS, LAT, LON; one row per place, the first one."""

    def read():
        df = _with_position(clean_header(read_delimited(spark, path, sep), fold=True))
        df = df.withColumnRenamed("_POSITION", "_position")
        df = df.select(
            strip("VILLE").alias("VILLE"), strip("PAYS").alias("PAYS"),
            to_number("LAT").alias("LAT"), to_number("LON").alias("LON"), "_position",
        )
        return first_per_key(df, ["VILLE", "PAYS"], ["_position"]).drop("_position")

    return or_empty(spark, read, schemas.CITY_COORDINATES)


def read_factor_table(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated factor table with each row's place in the file."""
    df = _with_position(clean_header(read_delimited(spark, path, "\t")))
    names = [c for c in ("subcategory", "subsubcategory", "total") if c in df.columns]
    return df.select(*[na_to_null(c).alias(c) for c in names], "_position")


def band_factors(transports: DataFrame, cars: DataFrame) -> DataFrame:
    """One factor per distance band: the first row that names the band, or a category's mean.

    Each table is read once and grouped to at most seven rows.
    """
    named = [
        F.when(contains_text("subsubcategory", text), F.lit(band))
        for band, text in domain.BAND_ROW_TEXT.items()
    ]
    bus = F.when(F.col("subcategory") == domain.BUS_CATEGORY, F.lit("bus"))
    car = F.when(F.col("subcategory") == domain.CAR_CATEGORY, F.lit("car"))
    rows = _rows_of_bands(transports, [*named, bus]).unionByName(_rows_of_bands(cars, [car]))
    grouped = rows.groupBy("BAND").agg(
        F.min_by("total", "_position").alias("first"), F.avg("total").alias("mean")
    )
    named_band = F.col("BAND").isin(*domain.BAND_ROW_TEXT)
    factor = F.when(named_band, F.col("first")).otherwise(F.col("mean"))
    return with_band_bounds(grouped.select("BAND", factor.alias("FACTOR")))


def _rows_of_bands(table: DataFrame, bands: list[Column]) -> DataFrame:
    return table.select(
        F.explode(F.array_compact(F.array(*bands))).alias("BAND"),
        to_number("total").alias("total"),
        "_position",
    )


def with_band_bounds(factors: DataFrame) -> DataFrame:
    """Attach code and bounds of the fixed bands to (BAND, FACTOR) rows."""

    def km(bound: float | None) -> str:
        return f"CAST({'NULL' if bound is None else bound} AS DOUBLE)"

    cases = " ".join(
        f"WHEN '{band}' THEN named_struct('CODE', '{code}', 'LO', {km(lo)}, 'LO_IN', {lo_in}, "
        f"'HI', {km(hi)}, 'HI_IN', {hi_in})"
        for band, code, lo, lo_in, hi, hi_in in domain.DISTANCE_BANDS
    )
    bounds = factors.withColumn("_of", F.expr(f"CASE BAND {cases} END"))
    return bounds.select("BAND", "_of.*", F.col("FACTOR").cast("double").alias("FACTOR"))
