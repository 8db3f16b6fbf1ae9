"""The twenty questions asked of the warehouse, plus one variant.

Each takes a Star and returns a lazy DataFrame. Literals are defaults, so the
same question can be asked of another period, site or sector. Facts meet
dimensions in inner joins; equal measures are ordered by the group key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger import domain
from sootledger.functions.dates import year_month, years_between
from sootledger.operators.aggregates import (
    count_distinct,
    count_rows,
    tonnes_by,
    total_tonnes,
)
from sootledger.operators.filters import (
    between_days,
    ci_equals,
    ci_in,
    ci_prefix,
    folded,
)
from sootledger.operators.joins import semi_in, star
from sootledger.operators.ranking import order_rows, top_n
from sootledger.sinks.ledger import Layout
from sootledger.session import cut_lineage
from sootledger.sources.warehouse import Star, load_star

TRIP_DAY, BUY_DAY = "ID_DATE_MISSION", "ID_DATE_ACHAT"


def _trips(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return star(fact, dim, "ID_MISSION")


def _purchases(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return star(fact, dim, "ID_MATERIEL")


def _per_person(rows: DataFrame, people: DataFrame, *keys: str) -> DataFrame:
    """Impact summed per person (and more keys) and joined to the people asked for.

    The sum comes first: a person with very many rows is one row in the join.
    """
    summed = rows.groupBy("ID_PERSONNEL", *keys).agg(F.sum("IMPACT").alias("IMPACT"))
    return star(summed, people.select("ID_PERSONNEL", "FONCTION_PERSONNEL"), "ID_PERSONNEL")


def _tonnes_per_sector(rows: DataFrame, people: DataFrame) -> DataFrame:
    return tonnes_by(_per_person(rows, people), ["FONCTION_PERSONNEL"], "impact_total_tonnes")


def q1(s: Star, sector: str = "Cadre", site: str = "paris") -> DataFrame:
    """How many executives work at the Paris site? (the sector is case-sensitive)"""
    people = ci_equals(s.dim_personnel, "ID_SITE", site)
    people = people.filter(F.col("FONCTION_PERSONNEL") == sector)
    return count_distinct(people, "ID_PERSONNEL", "nb_cadres")


def q2(
    s: Star, sector: str = "ingénieur data", sites: Sequence[str] = domain.US_SITES
) -> DataFrame:
    """How many data engineers work at the sites in the United States?"""
    people = ci_in(ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector), "ID_SITE", sites)
    return count_distinct(people, "ID_PERSONNEL", "nb_data_engineers")


def q3(s: Star, sector: str = "ingénieur informaticien") -> DataFrame:
    """How many computer engineers work in the organisation?"""
    people = ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector)
    return count_distinct(people, "ID_PERSONNEL", "nb_ingenieurs_info")


def q4(
    s: Star, prefix: str = "pc fixe", start: str = "2026-06-01", end: str = "2026-09-30"
) -> DataFrame:
    """How many desktop PCs were bought from June to September?"""
    bought = _purchases(
        between_days(s.fait_materiel, BUY_DAY, start, end),
        ci_prefix(s.dim_materiel, "TYPE", prefix),
    )
    return count_rows(bought, "ID_MATERIEL", "nb_pc_fixes")


def q5(
    s: Star, kind: str = "pc fixe sans ecran", start: str = "2026-05-01", end: str = "2026-10-31"
) -> DataFrame:
    """Impact of desktop PCs without screen from May to October."""
    bought = _purchases(
        between_days(s.fait_materiel, BUY_DAY, start, end),
        ci_equals(s.dim_materiel, "TYPE", kind),
    )
    return total_tonnes(bought, "impact_total_pc_fixes_tonnes")


def q6(
    s: Star,
    kind: str = "pc portable",
    sector: str = "ingénieur data",
    sites: Sequence[str] = ("london", "newyork"),
    start: str = "2026-05-01",
    end: str = "2026-10-31",
) -> DataFrame:
    """Impact of the laptops of data engineers in London and New York."""
    fact = ci_in(between_days(s.fait_materiel, BUY_DAY, start, end), "ID_SITE", sites)
    bought = _purchases(fact, ci_equals(s.dim_materiel, "TYPE", kind))
    people = ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector)
    return total_tonnes(_per_person(bought, people), "impact_pc_portables_tonnes")


def q7(
    s: Star,
    kind: str = "ecran",
    sector: str = "cadre",
    start: str = "2026-07-01",
    end: str = "2026-09-30",
) -> DataFrame:
    """Impact of the screens bought by executives from July to September."""
    fact = between_days(s.fait_materiel, BUY_DAY, start, end)
    bought = _purchases(fact, ci_equals(s.dim_materiel, "TYPE", kind))
    people = ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector)
    return total_tonnes(_per_person(bought, people), "impact_ecrans_tonnes")


def q8(
    s: Star,
    sites: Sequence[str] = domain.EUROPEAN_SITES,
    start: str = "2026-05-01",
    end: str = "2026-10-31",
) -> DataFrame:
    """Impact of the trips of the European sites from May to October."""
    fact = ci_in(between_days(s.fait_mission, TRIP_DAY, start, end), "ID_SITE", sites)
    return total_tonnes(_trips(fact, s.dim_mission), "impact_missions_europe_tonnes")


def q9(
    s: Star,
    transport: str = "avion",
    sites: Sequence[str] = domain.EUROPEAN_SITES,
    n: int = 5,
) -> DataFrame:
    """The five days with the greatest flight impact at the European sites."""
    flights = _trips(
        ci_in(s.fait_mission, "ID_SITE", sites), ci_equals(s.dim_mission, "TRANSPORT", transport)
    )
    per_day = tonnes_by(flights, [TRIP_DAY], "impact_journalier_tonnes")
    return top_n(per_day, "impact_journalier_tonnes", n, [TRIP_DAY])


def _all_emissions(s: Star, *columns: str) -> DataFrame:
    trips = _trips(s.fait_mission, s.dim_mission).select(*columns, "IMPACT")
    return trips.unionByName(_purchases(s.fait_materiel, s.dim_materiel).select(*columns, "IMPACT"))


def q10(s: Star, n: int = 1) -> DataFrame:
    """The sector with the greatest impact, trips and equipment together."""
    totals = _tonnes_per_sector(_all_emissions(s, "ID_PERSONNEL"), s.dim_personnel)
    return top_n(totals, "impact_total_tonnes", n, ["FONCTION_PERSONNEL"])


def q11(s: Star, n: int = 1) -> DataFrame:
    """The site with the greatest impact, trips and equipment together."""
    totals = tonnes_by(_all_emissions(s, "ID_SITE"), ["ID_SITE"], "impact_total_tonnes")
    return top_n(totals, "impact_total_tonnes", n, ["ID_SITE"])


def _tonnes_to_sites(
    s: Star, city_to_site: Mapping[str, str], start: str, end: str
) -> DataFrame:
    """Sum per city first: the semi join then sees cities, however many trips go to one."""
    trips = _trips(between_days(s.fait_mission, TRIP_DAY, start, end), s.dim_mission)
    city = folded(trips, "VILLE_DESTINATION")
    per_city = trips.groupBy(city.alias("city")).agg(F.sum("IMPACT").alias("IMPACT"))
    site = F.col("city")
    for spelling, name in city_to_site.items():
        site = F.when(F.col("city") == spelling, F.lit(name)).otherwise(site)
    sites = s.dim_personnel.select(folded(s.dim_personnel, "ID_SITE").alias("site")).distinct()
    return total_tonnes(semi_in(per_city, site, sites), "impact_inter_sites_tonnes")


def q12(s: Star, start: str = "2026-09-01", end: str = "2026-09-30") -> DataFrame:
    """Impact of the trips whose destination bears the name of a site, in September."""
    return _tonnes_to_sites(s, {}, start, end)


def q12b(s: Star, start: str = "2026-09-01", end: str = "2026-09-30") -> DataFrame:
    """q12 with the other spellings of site cities recognised."""
    return _tonnes_to_sites(s, domain.CITY_TO_SITE, start, end)


def q13(
    s: Star,
    kind: str = "conférence",
    site: str = "la",
    start: str = "2026-07-01",
    end: str = "2026-07-31",
) -> DataFrame:
    """Impact of the conferences of Los Angeles staff in July."""
    fact = ci_equals(between_days(s.fait_mission, TRIP_DAY, start, end), "ID_SITE", site)
    trips = _trips(fact, ci_equals(s.dim_mission, "TYPE_MISSION", kind))
    return total_tonnes(trips, "impact_conferences_tonnes")


def q14(
    s: Star,
    kind: str = "conférence",
    start: str = "2026-05-01",
    end: str = "2026-09-30",
    n: int = 1,
) -> DataFrame:
    """The sector with the greatest conference impact from May to September."""
    fact = between_days(s.fait_mission, TRIP_DAY, start, end)
    trips = _trips(fact, ci_equals(s.dim_mission, "TYPE_MISSION", kind))
    totals = _tonnes_per_sector(trips, s.dim_personnel)
    return top_n(totals, "impact_total_tonnes", n, ["FONCTION_PERSONNEL"])


def q15(
    s: Star,
    sector: str = "ingénieur data",
    kind: str = "formation",
    start: str = "2026-07-01",
    end: str = "2026-09-30",
) -> DataFrame:
    """Average age, per trip, of the data engineers on training from July to September."""
    fact = between_days(s.fait_mission, TRIP_DAY, start, end)
    trips = _trips(fact, ci_equals(s.dim_mission, "TYPE_MISSION", kind).select("ID_MISSION"))
    people = ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector)
    days = trips.groupBy("ID_PERSONNEL", TRIP_DAY).agg(F.count(F.lit(1)).alias("n"))
    aged = star(days, people.select("ID_PERSONNEL", "DT_NAISS"), "ID_PERSONNEL")
    age = years_between(TRIP_DAY, "DT_NAISS")
    weight = F.when(age.isNotNull(), F.col("n"))
    return aged.agg(F.try_divide(F.sum(age * weight), F.sum(weight)).alias("age_moyen"))


def q16(s: Star, start: str = "2026-05-01", end: str = "2026-10-31", n: int = 1) -> DataFrame:
    """The destination with the greatest impact from May to October."""
    trips = _trips(between_days(s.fait_mission, TRIP_DAY, start, end), s.dim_mission)
    totals = tonnes_by(trips, ["VILLE_DESTINATION"], "impact_cumule_tonnes")
    return top_n(totals, "impact_cumule_tonnes", n, ["VILLE_DESTINATION"])


def q17(
    s: Star,
    sector: str = "cadre",
    sites: Sequence[str] = domain.EUROPEAN_SITES,
    start: str = "2026-05-01",
    end: str = "2026-05-31",
    n: int = 3,
) -> DataFrame:
    """The three kinds of trip with the greatest impact, executives in Europe in May."""
    fact = ci_in(between_days(s.fait_mission, TRIP_DAY, start, end), "ID_SITE", sites)
    people = ci_equals(s.dim_personnel, "FONCTION_PERSONNEL", sector)
    trips = _per_person(_trips(fact, s.dim_mission), people, "TYPE_MISSION")
    totals = tonnes_by(trips, ["TYPE_MISSION"], "impact_total_tonnes")
    return top_n(totals, "impact_total_tonnes", n, ["TYPE_MISSION"])


def q18(s: Star, site: str = "paris", n: int = 5) -> DataFrame:
    """The five trips of the Paris site with the greatest impact, with a label."""
    keys = ["ID_MISSION", "TYPE_MISSION", "VILLE_DESTINATION"]
    trips = _trips(ci_equals(s.fait_mission, "ID_SITE", site), s.dim_mission)
    best = top_n(tonnes_by(trips, keys, "impact_total_tonnes"), "impact_total_tonnes", n, keys)
    label = F.concat(
        F.col("ID_MISSION").cast("string"), F.lit(" ("), F.col("TYPE_MISSION"), F.lit(" -> "),
        F.col("VILLE_DESTINATION"), F.lit(")"),
    )
    return best.withColumn("Label", label)


def q19(s: Star) -> DataFrame:
    """Monthly trip impact per means of transport and site."""
    keys = [year_month(TRIP_DAY).alias("Mois"), "TRANSPORT", F.col("ID_SITE").alias("Site")]
    trips = _trips(s.fait_mission, s.dim_mission)
    return tonnes_by(trips, keys, "impact_total_tonnes").orderBy("Mois", "TRANSPORT", "Site")


def q20(s: Star) -> DataFrame:
    """Monthly impact of the organisation, trips and equipment."""

    def monthly(rows: DataFrame, day: str, label: str) -> DataFrame:
        totals = tonnes_by(rows, [year_month(day).alias("Mois")], "impact_tonnes")
        return totals.select("Mois", F.lit(label).alias("Categorie"), "impact_tonnes")

    trips = monthly(_trips(s.fait_mission, s.dim_mission), TRIP_DAY, "Missions")
    bought = monthly(
        _purchases(s.fait_materiel, s.dim_materiel), BUY_DAY, "Matériel Informatique"
    )
    return order_rows(trips.unionByName(bought), "Mois")


QUESTIONS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (q1, q2, q3, q4, q5, q6, q7, q8, q9, q10, q11, q12, q12b, q13, q14, q15, q16, q17,
              q18, q19, q20)
}


def run_questions(
    s: Star, wanted: Sequence[str]
) -> dict[str, DataFrame | Exception]:
    """Run several questions by name; one that fails, in its plan or while running, does not stop the others.

    Each result is kept as a reliable checkpoint, so it is computed once, here.
    """
    results: dict[str, DataFrame | Exception] = {}
    for name in wanted:
        try:
            results[name] = cut_lineage(QUESTIONS[name](s))
        except Exception as e:  # the caller shows the failure beside the other results
            results[name] = e
    return results


def run_questions_on(
    spark: SparkSession, layout: Layout, version: str, wanted: Sequence[str]
) -> dict[str, DataFrame | Exception]:
    """Several questions asked of one stored version: a label or a day."""
    return run_questions(load_star(spark, layout, version), wanted)
