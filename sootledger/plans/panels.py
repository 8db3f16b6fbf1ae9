"""The tables behind the four views of the footprint: overall, trips, equipment, sectors.

``trips_wide`` and ``equipment_wide`` join facts to dimensions with left joins,
so a fact without dimension counts 0 t; every panel is one aggregation of them.
Only the sector panels need people. They sum per person first and join the sums,
so ``sector=False`` spares the other panels that join altogether.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sootledger import domain
from sootledger.functions.dates import day_label, year_month
from sootledger.functions.numbers import thousands, tonnes_or_zero
from sootledger.functions.text import destination_label, label_missing, route_label
from sootledger.operators.aggregates import (
    day_bounds,
    group_total,
    matrix,
    missing_percent,
    sorted_values,
    sum_or_zero,
)
from sootledger.operators.filters import filter_equal, filter_period, only_positive
from sootledger.operators.joins import outer_add, reconcile_site, star
from sootledger.operators.ranking import (
    first_per_key,
    order_by_list,
    order_rows,
    reindex_to_list,
    top_n,
)
from sootledger.operators.sets import stack, tagged
from sootledger.session import cut_lineage
from sootledger.sources.warehouse import Star

Period = tuple[str | dt.date | None, str | dt.date | None]
ALWAYS: Period = (None, None)
LINEAGE = ("ingest_date", "load_order")


def _wide(
    fact: DataFrame, dim: DataFrame, people: DataFrame, key: str, day: str, sector: bool
) -> DataFrame:
    df = star(fact, dim, key, how="left")
    df = df.withColumn("DATE", F.to_date(day))
    impact = tonnes_or_zero("IMPACT") if "IMPACT" in df.columns else F.lit(0.0)
    df = df.withColumns({"tCO2e": impact, "MOIS": year_month("DATE")})
    if not sector:
        return reconcile_site(df)
    brought = ["ID_PERSONNEL", "FONCTION_PERSONNEL"]
    if "ID_SITE" not in df.columns and "ID_SITE" in people.columns:
        brought.append("ID_SITE")
    return reconcile_site(star(df, people.select(*brought), "ID_PERSONNEL", how="left"))


def trips_wide(s: Star, sector: bool = True) -> DataFrame:
    df = _wide(
        s.fait_mission, s.dim_mission, s.dim_personnel, "ID_MISSION", "ID_DATE_MISSION", sector
    )
    if "TRANSPORT" in df.columns:
        df = df.withColumn("TRANSPORT", F.coalesce("TRANSPORT", F.lit(domain.MISSING_LABEL)))
    if {"VILLE_DESTINATION", "PAYS_DESTINATION"} <= set(df.columns):
        label = destination_label("VILLE_DESTINATION", "PAYS_DESTINATION")
    else:
        label = F.lit("Inconnue")
    return df.withColumn("DESTINATION", label)


def equipment_wide(s: Star, sector: bool = True) -> DataFrame:
    df = _wide(
        s.fait_materiel, s.dim_materiel, s.dim_personnel, "ID_MATERIEL", "ID_DATE_ACHAT", sector
    )
    if "TYPE" in df.columns:
        df = df.withColumn("TYPE", F.coalesce("TYPE", F.lit(domain.MISSING_LABEL)))
    return df


def analytical_frames(
    s: Star, sector: bool = True, materialise: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Both wide frames; ``materialise`` checkpoints them when many panels will read them."""
    frames = trips_wide(s, sector), equipment_wide(s, sector)
    return tuple(cut_lineage(f) for f in frames) if materialise else frames


def _both(trips: DataFrame, equipment: DataFrame, period: Period, *columns: str) -> DataFrame:
    """Emissions of both kinds in a period, tagged by source."""
    parts = [
        tagged(filter_period(df, *period).select(*columns, "tCO2e"), source)
        for df, source in ((trips, "mission"), (equipment, "materiel"))
    ]
    return stack(*parts)


# ── Overall ──────────────────────────────────────────────────────────────────


def kpis(trips: DataFrame, equipment: DataFrame, period: Period = ALWAYS) -> DataFrame:
    """Total, trip and equipment emissions, with their display texts."""

    def of(source: str):
        return sum_or_zero(F.when(F.col("source") == source, F.col("tCO2e")))

    totals = _both(trips, equipment, period).agg(
        of("mission").alias("missions"), of("materiel").alias("materiel")
    )
    totals = totals.withColumn("total", F.col("missions") + F.col("materiel"))
    return totals.select(
        "total", "missions", "materiel",
        *[thousands(c).alias(f"{c}_texte") for c in ("total", "missions", "materiel")],
    )


def by_site(trips: DataFrame, equipment: DataFrame, period: Period = ALWAYS) -> DataFrame:
    both = outer_add([_both(trips, equipment, period, "ID_SITE")], ["ID_SITE"], "tCO2e")
    return order_rows(both, "tCO2e", descending=True)


def split_by_source(trips: DataFrame, equipment: DataFrame, period: Period = ALWAYS) -> DataFrame:
    """Two rows, trips and equipment; a negative total shows as 0."""
    totals = kpis(trips, equipment, period).unpivot(
        [], ["missions", "materiel"], "source", "tCO2e"
    )
    label = F.when(F.col("source") == "missions", "Missions").otherwise("Matériel informatique")
    return totals.select(
        label.alias("source"), F.greatest(F.col("tCO2e"), F.lit(0.0)).alias("tCO2e")
    )


def date_range(trips: DataFrame, equipment: DataFrame) -> DataFrame:
    default = (domain.FIRST_DAY, domain.LAST_DAY)
    return day_bounds([(trips, "DATE"), (equipment, "DATE")], default)


# ── Trips ────────────────────────────────────────────────────────────────────


def filter_options(trips: DataFrame, period: Period = ALWAYS) -> dict[str, DataFrame]:
    """Sorted choices of each trip filter in a period."""
    rows = filter_period(trips, *period)
    wanted = ("ID_SITE", "TYPE_MISSION", "TRANSPORT")
    return {c: sorted_values(rows, c) for c in wanted if c in rows.columns}


def filter_option_rows(trips: DataFrame, period: Period = ALWAYS) -> DataFrame:
    """The choices of all filters as (field, value) rows, found in one pass."""
    rows = filter_period(trips, *period)
    fields = [c for c in ("ID_SITE", "TYPE_MISSION", "TRANSPORT") if c in rows.columns]
    choices = rows.select(*fields).distinct().unpivot([], fields, "field", "value")
    return choices.na.drop().distinct().orderBy("field", "value")


def _chosen(trips: DataFrame, site: str | None, kind: str | None, transport: str | None):
    return filter_equal(trips, ID_SITE=site, TYPE_MISSION=kind, TRANSPORT=transport)


def monthly_trips(
    trips: DataFrame, site: str | None = None, kind: str | None = None,
    transport: str | None = None,
) -> DataFrame:
    return order_rows(group_total(_chosen(trips, site, kind, transport), "MOIS"), "MOIS")


def by_transport(trips: DataFrame, site: str | None = None, kind: str | None = None) -> DataFrame:
    """Positive emissions per means of transport; the transport filter does not apply here."""
    totals = only_positive(group_total(_chosen(trips, site, kind, None), "TRANSPORT"), "tCO2e")
    labelled = totals.withColumn("label", thousands("tCO2e"))
    return order_by_list(labelled, "TRANSPORT", domain.TRANSPORT_ORDER)


def top_trips(
    trips: DataFrame, n: int = 10, site: str | None = None, kind: str | None = None,
    transport: str | None = None, order: Sequence[str] | None = None,
) -> DataFrame:
    """The n trips with the greatest emissions, one row per trip, with display texts.

    Of a trip sent more than once, the first row in the given order counts, whatever its
    emissions. Without an order it is the one loaded first, where the rows carry the day they came and
    their place in it (facts of a loaded or published warehouse do), else the one of the earliest day.
    """
    if order is None:
        order = LINEAGE if set(LINEAGE) <= set(trips.columns) else ("DATE",)
    rows = _chosen(trips, site, kind, transport).withColumn(
        "route", route_label("VILLE_DEPART", "VILLE_DESTINATION")
    )
    columns = dict.fromkeys(["ID_MISSION", "route", "DATE", "tCO2e", *order])
    once = first_per_key(rows.select(*columns), "ID_MISSION", [*order, "DATE", "tCO2e", "route"])
    best = top_n(only_positive(once, "tCO2e"), "tCO2e", n, ["ID_MISSION"])
    return best.select(
        "ID_MISSION", "route", day_label("DATE").alias("jour"), "tCO2e",
        F.concat(thousands("tCO2e"), F.lit(" tCO2e")).alias("label"),
        F.length("route").alias("route_len"),
    )


# ── Equipment ────────────────────────────────────────────────────────────────


def _labelled_totals(df: DataFrame, column: str, ascending: bool, n: int | None) -> DataFrame:
    totals = group_total(df, column).withColumn(column, label_missing(column))
    totals = only_positive(totals, "tCO2e")
    if n:
        totals = top_n(totals, "tCO2e", n, [column])
    totals = totals.withColumn("label", thousands("tCO2e"))
    return order_rows(totals, "tCO2e", descending=not ascending)


def equipment_by_type(
    equipment: DataFrame, period: Period = ALWAYS, n: int | None = None
) -> DataFrame:
    return _labelled_totals(filter_period(equipment, *period), "TYPE", True, n)


def equipment_by_site(
    equipment: DataFrame, period: Period = ALWAYS, n: int | None = None
) -> DataFrame:
    return _labelled_totals(filter_period(equipment, *period), "ID_SITE", False, n)


def monthly_equipment(equipment: DataFrame, period: Period = ALWAYS) -> DataFrame:
    return order_rows(group_total(filter_period(equipment, *period), "MOIS"), "MOIS")


def missing_impact(s: Star) -> DataFrame:
    """Percentage of equipment without impact, over the whole dimension."""
    return missing_percent(s.dim_materiel, "IMPACT", domain.MISSING_ALERT_PERCENT)


# ── Sectors ──────────────────────────────────────────────────────────────────


def _with_sector(
    trips: DataFrame, equipment: DataFrame, people: DataFrame, period: Period, *extra: str
) -> DataFrame:
    """Sums per person (and more keys) with the person's sector: few rows reach the join."""
    keys = ["ID_PERSONNEL", *extra]
    per_person = outer_add([_both(trips, equipment, period, *keys)], keys, "tCO2e")
    sectors = people.select("ID_PERSONNEL", "FONCTION_PERSONNEL")
    return star(per_person, sectors, "ID_PERSONNEL", how="left")


def by_sector(
    trips: DataFrame, equipment: DataFrame, people: DataFrame, period: Period = ALWAYS
) -> DataFrame:
    """Positive emissions of the listed sectors, in list order."""
    totals = group_total(_with_sector(trips, equipment, people, period), "FONCTION_PERSONNEL")
    listed = reindex_to_list(totals, "FONCTION_PERSONNEL", domain.SECTOR_ORDER, "tCO2e")
    return only_positive(listed, "tCO2e")


def sector_site_matrix(
    trips: DataFrame, equipment: DataFrame, people: DataFrame, period: Period = ALWAYS,
    sites: Sequence[str] | None = None,
) -> DataFrame:
    """Sectors as rows in list order, sites as columns."""
    summed = _with_sector(trips, equipment, people, period, "ID_SITE")
    listed = summed.filter(F.col("FONCTION_PERSONNEL").isin(*domain.SECTOR_ORDER))
    crossed = matrix(listed, "FONCTION_PERSONNEL", "ID_SITE", "tCO2e", sites)
    return order_by_list(crossed, "FONCTION_PERSONNEL", domain.SECTOR_ORDER)


def top_emitters(
    trips: DataFrame, equipment: DataFrame, period: Period = ALWAYS, n: int = 10
) -> DataFrame:
    both = _both(trips, equipment, period, "ID_PERSONNEL")
    return top_n(outer_add([both], ["ID_PERSONNEL"], "tCO2e"), "tCO2e", n, ["ID_PERSONNEL"])
