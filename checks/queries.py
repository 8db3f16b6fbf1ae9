"""Registered queries: library jobs and operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.mapping import frame, star, table
from sootledger import domain, schemas
from sootledger.functions import (
    add_days,
    blank_to_null,
    contains_text,
    day_label,
    day_of_file,
    half_even,
    haversine_km,
    is_default_model,
    label_missing,
    segment,
    site_of,
    strip,
    thousands,
    to_day,
    to_number,
    to_tonnes,
    translate_values,
    year_month,
    years_between,
)
from sootledger.operators import aggregates, contract, filters, joins, ranking, sets
from sootledger.plans import enrich, loading, panels, quality, questions
from sootledger.sources.drops import dedupe_file_rows
from sootledger.sources.references import band_factors, clean_distances, split_impacts
from sootledger.sources.warehouse import days_of, rebuild_from_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The years and words the questions are asked with on the test tables.
YEAR = 1997
PERIOD = (f"{YEAR}-05-01", f"{YEAR}-10-31")
SITES = list(domain.SITE_NAMES)
EVENT_WORDS = {"click": "clic", "view": "vue", "purchase": "achat"}
PRIORITY_ORDER = ["3-MEDIUM", "1-URGENT", "9-NONE"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _question(name: str, measure: str | None, **arguments) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = questions.QUESTIONS[name](star(spark, sf_dir), **arguments)
        return rounded(df, measure) if measure else df

    QUERIES[name] = run


def _dates(start: str, end: str) -> dict[str, str]:
    return {"start": f"{YEAR}-{start}", "end": f"{YEAR}-{end}"}


_question("q1", None)
_question("q2", None)
_question("q3", None)
_question("q4", None, **_dates("06-01", "09-30"))
_question("q5", "impact_total_pc_fixes_tonnes", **_dates("05-01", "10-31"))
_question("q6", "impact_pc_portables_tonnes", **_dates("05-01", "10-31"))
_question("q7", "impact_ecrans_tonnes", **_dates("07-01", "09-30"))
_question("q8", "impact_missions_europe_tonnes", **_dates("05-01", "10-31"))
_question("q9", "impact_journalier_tonnes")
_question("q10", "impact_total_tonnes")
_question("q11", "impact_total_tonnes")
_question("q12", "impact_inter_sites_tonnes", **_dates("09-01", "09-30"))
_question("q12b", "impact_inter_sites_tonnes", **_dates("09-01", "09-30"))
_question("q13", "impact_conferences_tonnes", **_dates("07-01", "07-31"))
_question("q14", "impact_total_tonnes", **_dates("05-01", "09-30"))
_question("q15", "age_moyen", **_dates("07-01", "09-30"))
_question("q16", "impact_cumule_tonnes", **_dates("05-01", "10-31"))
_question("q17", "impact_total_tonnes", **_dates("05-01", "05-31"))
_question("q18", "impact_total_tonnes")
_question("q19", "impact_total_tonnes")
_question("q20", "impact_tonnes")


# ── Panels ───────────────────────────────────────────────────────────────────


def _wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = star(spark, sf_dir)
    return panels.trips_wide(s), panels.equipment_wide(s)


def _emissions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = star(spark, sf_dir)
    return panels.trips_wide(s, sector=False), panels.equipment_wide(s, sector=False)


@query
def panel_trips_wide(spark, sf_dir):
    wide = _wide(spark, sf_dir)[0]
    return rounded(wide, "tCO2e")


@query
def panel_equipment_wide(spark, sf_dir):
    return rounded(_wide(spark, sf_dir)[1], "tCO2e")


@query
def panel_kpis(spark, sf_dir):
    return rounded(panels.kpis(*_emissions(spark, sf_dir), PERIOD), "total", "missions", "materiel")


@query
def panel_by_site(spark, sf_dir):
    return rounded(panels.by_site(*_emissions(spark, sf_dir), PERIOD), "tCO2e")


@query
def panel_split(spark, sf_dir):
    return rounded(panels.split_by_source(*_emissions(spark, sf_dir), PERIOD), "tCO2e")


@query
def panel_filter_options(spark, sf_dir):
    return panels.filter_option_rows(_emissions(spark, sf_dir)[0], PERIOD)


@query
def panel_monthly_trips(spark, sf_dir):
    trips = _emissions(spark, sf_dir)[0]
    return rounded(panels.monthly_trips(trips, site="Paris", kind="Formation"), "tCO2e")


@query
def panel_by_transport(spark, sf_dir):
    df = panels.by_transport(_emissions(spark, sf_dir)[0], site="LA")
    return rounded(df, "tCO2e")


@query
def panel_top_trips(spark, sf_dir):
    return rounded(panels.top_trips(_emissions(spark, sf_dir)[0]), "tCO2e")


@query
def panel_top_trips_resent(spark, sf_dir):
    """Every trip is sent again with an earlier day and other emissions: what came first counts."""
    trips = _emissions(spark, sf_dir)[0]
    again = trips.withColumns({
        "DATE": F.date_sub("DATE", 5), "tCO2e": F.col("tCO2e") * 3, "load_order": F.lit(2)
    })
    both = trips.withColumn("load_order", F.lit(1)).unionByName(again)
    return rounded(panels.top_trips(both, order=["load_order"]), "tCO2e")


@query
def panel_equipment_by_type(spark, sf_dir):
    df = panels.equipment_by_type(_emissions(spark, sf_dir)[1], PERIOD)
    return rounded(df, "tCO2e")


@query
def panel_equipment_by_site(spark, sf_dir):
    return rounded(panels.equipment_by_site(_emissions(spark, sf_dir)[1], PERIOD), "tCO2e")


@query
def panel_monthly_equipment(spark, sf_dir):
    return rounded(panels.monthly_equipment(_emissions(spark, sf_dir)[1]), "tCO2e")


@query
def panel_missing_impact(spark, sf_dir):
    return rounded(panels.missing_impact(star(spark, sf_dir)), "missing_pct")


@query
def panel_by_sector(spark, sf_dir):
    people = frame(spark, sf_dir, "dim_personnel")
    return rounded(panels.by_sector(*_emissions(spark, sf_dir), people, PERIOD), "tCO2e")


@query
def panel_sector_site_matrix(spark, sf_dir):
    people = frame(spark, sf_dir, "dim_personnel")
    df = panels.sector_site_matrix(*_emissions(spark, sf_dir), people, PERIOD)
    return rounded(df, *SITES)


@query
def panel_top_emitters(spark, sf_dir):
    return rounded(panels.top_emitters(*_emissions(spark, sf_dir), PERIOD), "tCO2e")


@query
def panel_date_range(spark, sf_dir):
    return panels.date_range(*_emissions(spark, sf_dir))


# ── Cleaning and enrichment ──────────────────────────────────────────────────


@query
def personnel_dimension(spark, sf_dir):
    return enrich.personnel_dimension(frame(spark, sf_dir, "raw_personnel"))


def _impacts(spark, sf_dir):
    return split_impacts(frame(spark, sf_dir, "impacts"))


def _materiel_log(spark, sf_dir) -> DataFrame:
    raw = frame(spark, sf_dir, "raw_equipment")
    return enrich.clean_equipment(raw, *_impacts(spark, sf_dir))


@query
def impact_by_model(spark, sf_dir):
    return _impacts(spark, sf_dir)[0]


@query
def impact_by_type(spark, sf_dir):
    return _impacts(spark, sf_dir)[1]


@query
def equipment_impact(spark, sf_dir):
    """Rows per outcome of the impact rule, over every purchase."""
    df = _materiel_log(spark, sf_dir)
    return df.groupBy("TYPE", "MODELE", "IMPACT").agg(F.count(F.lit(1)).alias("n"))


@query
def clean_equipment(spark, sf_dir):
    return _materiel_log(spark, sf_dir)


@query
def distinct_file_rows(spark, sf_dir):
    """Purchases without their own number: rows of a file that then are equal become one."""
    raw = frame(spark, sf_dir, "raw_equipment").withColumn("ID_MATERIELINFO", F.lit("b"))
    raw = raw.withColumn("PRENOM_PERSONNEL", F.substring("PRENOM_PERSONNEL", -1, 1))
    raw = raw.withColumn("ID_PERSONNEL", F.col("site_dir")).withColumn("NOM_PERSONNEL", F.lit(None).cast("string"))
    return dedupe_file_rows(raw, domain.EQUIPMENT_COLUMNS)


@query
def transport_factors(spark, sf_dir):
    df = band_factors(frame(spark, sf_dir, "transports"), frame(spark, sf_dir, "cars"))
    return rounded(df, "FACTOR")


def _bands(spark, sf_dir):
    return band_factors(frame(spark, sf_dir, "transports"), frame(spark, sf_dir, "cars"))


def _distances(spark, sf_dir) -> DataFrame:
    return clean_distances(frame(spark, sf_dir, "known_distances")).distinct()


@query
def trip_impact(spark, sf_dir):
    """Band factor and impact of every order, distances on the band bounds included."""
    raw = frame(spark, sf_dir, "raw_trips")
    trips = raw.select("ID_MISSION", "TRANSPORT", "ALLER_RETOUR").withColumn(
        "DISTANCE_KM", 100.0 * (F.col("ID_MISSION").cast("bigint") % 60)
    )
    return enrich.trip_impact(trips, _bands(spark, sf_dir))


@query
def distance_of_pairs(spark, sf_dir):
    """Great-circle distance of every pair of trips; unknown cities give NULL."""
    pairs = frame(spark, sf_dir, "known_distances").select(*domain.DISTANCE_KEYS).distinct()
    return enrich.distance_of_pairs(pairs, frame(spark, sf_dir, "coordinates"), ellipsoid=False)


@query
def missing_distances(spark, sf_dir):
    """Distances that the reference lacks and the trips need."""
    raw = frame(spark, sf_dir, "raw_trips")
    coordinates = frame(spark, sf_dir, "coordinates")
    return enrich.missing_distances(raw, _distances(spark, sf_dir), coordinates, ellipsoid=False)


@query
def missing_distances_ellipsoid(spark, sf_dir):
    raw, coordinates = frame(spark, sf_dir, "raw_trips"), frame(spark, sf_dir, "coordinates")
    return enrich.missing_distances(raw, _distances(spark, sf_dir), coordinates)


@query
def distance_reference(spark, sf_dir):
    raw, coordinates = frame(spark, sf_dir, "raw_trips"), frame(spark, sf_dir, "coordinates")
    return enrich.distance_reference(raw, coordinates, ellipsoid=False)


@query
def distance_reference_ellipsoid(spark, sf_dir):
    raw, coordinates = frame(spark, sf_dir, "raw_trips"), frame(spark, sf_dir, "coordinates")
    return enrich.distance_reference(raw, coordinates)


@query
def unlocated_places(spark, sf_dir):
    raw, coordinates = frame(spark, sf_dir, "raw_trips"), frame(spark, sf_dir, "coordinates")
    return enrich.unlocated_places(raw, coordinates)


def _mission_log(spark, sf_dir) -> DataFrame:
    raw, coordinates = frame(spark, sf_dir, "raw_trips"), frame(spark, sf_dir, "coordinates")
    known = _distances(spark, sf_dir)
    added = enrich.missing_distances(raw, known, coordinates, ellipsoid=False)
    distances = enrich.complete_distances(known, added)
    return enrich.clean_trips(raw, distances, _bands(spark, sf_dir))


@query
def clean_trips(spark, sf_dir):
    return _mission_log(spark, sf_dir)


@query
def load_quality(spark, sf_dir):
    logs = {"mission": _mission_log(spark, sf_dir), "materiel": _materiel_log(spark, sf_dir)}
    df = quality.quality_report(logs)
    return rounded(df, "missing_impact_pct")


# ── Incremental loading ──────────────────────────────────────────────────────

BUY_COLUMNS = schemas.names(schemas.DIM_MATERIEL)


@query
def equipment_snapshot(spark, sf_dir):
    return loading.dim_snapshot(_materiel_log(spark, sf_dir), "ID_MATERIEL", BUY_COLUMNS)


@query
def equipment_delta(spark, sf_dir):
    return loading.dim_delta(_materiel_log(spark, sf_dir), "ID_MATERIEL", BUY_COLUMNS)


@query
def equipment_fact_rows(spark, sf_dir):
    columns = schemas.names(schemas.FAIT_MATERIEL)
    return loading.fact_rows(_materiel_log(spark, sf_dir), columns)


@query
def user_delta(spark, sf_dir):
    log = frame(spark, sf_dir, "event_log")
    return loading.dim_delta(log, "user_id", ["user_id", "event_type", "value"])


@query
def user_delta_of_days(spark, sf_dir):
    """New users since the second day, given the users of the first."""
    log = frame(spark, sf_dir, "event_log")
    later = F.col("ingest_date") >= F.lit("2024-01-02").cast("date")
    columns = ["user_id", "event_type", "value"]
    known = loading.dim_delta(log.filter(~later), "user_id", columns)
    return loading.dim_delta_of(log.filter(later), known, "user_id", columns)


@query
def repaired_user_deltas(spark, sf_dir):
    """Two days were loaded with other rows before: views were missing, and some later users were there."""
    log = frame(spark, sf_dir, "event_log")
    columns = ["user_id", "event_type", "value"]
    again = F.col("ingest_date").between(F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date"))
    wrong = log.filter(~again & (F.col("user_id") % 5 == 0)).withColumn("ingest_date", F.lit("2024-01-02").cast("date"))
    before = log.filter(~again | (F.col("event_type") != "view")).unionByName(wrong)
    deltas = loading.dim_delta(before, "user_id", columns)
    rows, other = loading.repaired_deltas(log, deltas, again, "user_id", columns)
    kept = deltas.filter(~again & ~F.col("ingest_date").isin(other)) if other else deltas.filter(~again)
    return kept.unionByName(rows)


@query
def user_snapshot(spark, sf_dir):
    log = frame(spark, sf_dir, "event_log")
    return loading.dim_snapshot(log, "user_id", ["user_id", "event_type", "value"])


@query
def daily_fact_rows(spark, sf_dir):
    return loading.fact_rows(frame(spark, sf_dir, "event_log"), ["user_id", "event_type"])


@query
def rebuilt_from_days(spark, sf_dir):
    days = loading.fact_rows(frame(spark, sf_dir, "event_log"), ["user_id", "event_type"])
    return rebuild_from_days(days, "user_id")


@query
def days_with_data(spark, sf_dir):
    return days_of(frame(spark, sf_dir, "event_log"))


# ── Generic operators ────────────────────────────────────────────────────────


@query
def schema_contract(spark, sf_dir):
    wanted = ["o_orderkey", " o_custkey ", "o_comment", "o_orderstatus"]
    kept, _ = contract.keep_columns(table(spark, sf_dir, "orders"), wanted)
    return contract.rename(kept, {"o_custkey": "customer_id"})


@query
def header_cleaning(spark, sf_dir):
    df = table(spark, sf_dir, "supplier")
    messy = df.toDF(" s_suppkey", "s_nÈme ", "s_nationkey", "s_acctbal")
    return contract.clean_header(messy, fold=True)


@query
def period_and_filters(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "DATE")
    df = filters.filter_tab_period(orders, (f"{YEAR}-01-01", None), (None, f"{YEAR}-12-31"))
    df = filters.filter_equal(df, o_orderstatus="F", o_orderpriority=None)
    return df.select("o_orderkey", "o_orderstatus", F.to_date("DATE").alias("day"))


@query
def prefix_in_and_positive(spark, sf_dir):
    part = filters.ci_prefix(table(spark, sf_dir, "part"), "p_type", "S")
    part = filters.ci_in(part, "p_brand", ["brand#1", "BRAND#12", "Brand#23"])
    return filters.only_positive(part, "p_retailprice").select("p_partkey", "p_type", "p_brand")


@query
def semi_join_in(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "supplier").select("s_nationkey").distinct()
    kept = joins.semi_in(customer, F.col("c_nationkey"), nations)
    return kept.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query
def anti_join_unseen(spark, sf_dir):
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    known = items.select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.unseen(orders, known, "o_orderkey").select("o_orderkey", "o_custkey")


@query
def left_star(spark, sf_dir):
    """Orders with their line items, orders without any included."""
    items = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    wide = joins.star(table(spark, sf_dir, "orders"), items, "o_orderkey", how="left")
    return wide.groupBy("o_orderkey").agg(
        F.count("l_linenumber").alias("n_lines"),
        F.round(aggregates.sum_or_zero("l_quantity"), 2).alias("quantity"),
    )


@query
def reconciled_site(spark, sf_dir):
    trips = frame(spark, sf_dir, "fait_mission")
    first = F.when(F.col("ID_SITE") != "Paris", F.col("ID_SITE"))
    sides = trips.select("ID_MISSION", first.alias("ID_SITE_x"), F.lit("?").alias("ID_SITE_y"))
    return joins.reconcile_site(sides, ["ID_SITE_x", "ID_SITE_y"])


@query
def derived_site(spark, sf_dir):
    trips = frame(spark, sf_dir, "fait_mission").select("ID_MISSION", "ID_PERSONNEL")
    return joins.reconcile_site(trips)


def _per_person(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "person")
    orders = orders.withColumn("person", F.when(F.col("person") % 7 != 0, F.col("person")))
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "person")
    return (
        aggregates.group_total(orders.withColumn("amount", F.col("o_totalprice")), "person", "amount"),
        aggregates.group_total(events.withColumn("amount", F.col("value")), "person", "amount"),
    )


@query
def outer_add(spark, sf_dir):
    df = joins.outer_add(_per_person(spark, sf_dir), ["person"], "amount")
    return rounded(df, "amount", digits=2)


@query
def outer_add_by_join(spark, sf_dir):
    df = joins.outer_add_join(*_per_person(spark, sf_dir), "person", "amount")
    return rounded(df, "amount", digits=2)


@query
def group_total_null_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keyed = orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return rounded(aggregates.group_total(keyed, "status", "o_totalprice"), "o_totalprice", digits=2)


@query
def pivot_matrix(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    df = aggregates.matrix(orders, "o_orderpriority", "o_orderstatus", "o_totalprice", ["F", "O", "P"])
    return rounded(df, "F", "O", "P", digits=2)


@query
def ordered_by_list(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    df = ranking.order_by_list(totals, "o_orderpriority", PRIORITY_ORDER)
    place = F.coalesce(ranking.listed_rank("o_orderpriority", PRIORITY_ORDER), F.lit(99))
    return df.withColumn("place", place)


@query
def reindexed_to_list(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count("*").cast("double").alias("n")
    )
    return ranking.reindex_to_list(totals, "o_orderpriority", PRIORITY_ORDER, "n")


@query
def first_item_of_order(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranking.first_per_key(items, "l_orderkey", order).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query
def last_item_of_order(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranking.last_per_key(items, "l_orderkey", order).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query
def top_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_n(orders, "o_totalprice", 10, ["o_orderkey"])


@query
def sorted_options(spark, sf_dir):
    return aggregates.sorted_values(table(spark, sf_dir, "part"), "p_brand")


@query
def day_bounds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    items = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    default = (domain.FIRST_DAY, domain.LAST_DAY)
    return aggregates.day_bounds([(orders, "day"), (items, "day")], default)


@query
def value_bounds(spark, sf_dir):
    return aggregates.value_bounds(table(spark, sf_dir, "orders"), "o_totalprice")


@query
def load_counts(spark, sf_dir):
    wide = frame(spark, sf_dir, "dim_mission")
    watched = ["TRANSPORT", "PAYS_DESTINATION", "IMPACT"]
    return aggregates.load_counts(wide, ["TYPE_MISSION"], watched)


@query
def distinct_places(spark, sf_dir):
    return sets.distinct_places(frame(spark, sf_dir, "dim_mission"))


@query
def tagged_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_totalprice")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_quantity")
    both = sets.stack(sets.tagged(orders, "orders"), sets.tagged(items, "lineitem"))
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("n_price"),
        F.count("l_quantity").alias("n_quantity"), F.count_distinct("key").alias("n_keys"),
    )


@query
def distinct_rows(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return sets.distinct_rows(items)


# ── Functions ────────────────────────────────────────────────────────────────


@query
def translated_values(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    word = translate_values("event_type", EVENT_WORDS).alias("word")
    return events.groupBy(word).agg(F.count(F.lit(1)).alias("n"))


@query
def text_functions(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        segment("c_name", 1, "#").alias("number"),
        segment("c_name", 2, "#").alias("no_such_part"),
        site_of(F.concat(F.lit("KeyPers_"), "c_mktsegment", F.lit("_1"))).alias("site"),
        F.lower("c_mktsegment").alias("low"),
        F.upper(F.lower("c_mktsegment")).alias("up"),
        strip(F.concat(F.lit(" \t"), "c_name", F.lit(" \n"))).alias("stripped"),
        blank_to_null(F.when(F.col("c_custkey") % 2 == 0, F.lit("  "))).alias("blank"),
        label_missing(
            F.when(F.col("c_custkey") % 3 == 0, F.lit("nan"))
            .when(F.col("c_custkey") % 3 == 1, F.lit(" "))
            .otherwise(F.col("c_name"))
        ).alias("labelled"),
        contains_text(F.nullif("c_mktsegment", F.lit("BUILDING")), "MACH").alias("has_mach"),
        is_default_model(
            F.when(F.col("c_custkey") % 3 == 0, F.lit(" Modèle par défaut "))
            .when(F.col("c_custkey") % 3 == 1, F.lit("Modele"))
        ).alias("is_default"),
        F.length("c_name").alias("len"),
    )


@query
def date_functions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 10 != 0, F.concat(day.cast("string"), F.lit(" 23:59:59")))
    return orders.select(
        "o_orderkey",
        to_day(F.coalesce(text, F.lit("n'importe quoi"))).alias("day"),
        year_month(day).alias("month"),
        day_label(F.when(F.col("o_orderkey") % 10 != 0, day)).alias("label"),
        add_days(day, 1).alias("next_day"),
        F.round(years_between(day, F.to_date(F.lit("1980-02-29"))), 6).alias("years"),
        day_of_file(
            F.concat(F.lit("MISSION_"), F.date_format(day, "yyyyMMdd"), F.lit(".txt"))
        ).alias("file_day"),
    )


@query
def number_functions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    number = to_number(F.regexp_extract("props", r'"k": ([0-9]+)', 1))
    return events.select(
        "event_id",
        number.alias("k"),
        to_number("event_type").alias("not_a_number"),
        half_even(number / 8, 2).alias("half_even"),
        to_tonnes("value").alias("tonnes"),
        thousands(F.col("value") * 1000).alias("text"),
    )


@query
def haversine(spark, sf_dir):
    """Distance between the nations of customer and the supplier's nation of each line."""
    at = frame(spark, sf_dir, "coordinates")
    names = {"VILLE": "city", "LAT": "lat", "LON": "lon"}
    start = at.select(*[F.col(c).alias(f"{n}_1") for c, n in names.items()])
    end = at.select(*[F.col(c).alias(f"{n}_2") for c, n in names.items()])
    trips = frame(spark, sf_dir, "dim_mission").select(
        F.col("VILLE_DEPART").alias("city_1"), F.col("VILLE_DESTINATION").alias("city_2")
    ).distinct()
    placed = trips.join(start, "city_1").join(end, "city_2")
    ends = [F.col(c) for c in ("lat_1", "lon_1", "lat_2", "lon_2")]
    return placed.select("city_1", "city_2", F.round(haversine_km(*ends), 2).alias("km"))

