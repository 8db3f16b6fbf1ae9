"""SQL counterparts of the registered queries, written apart from the library."""

from __future__ import annotations

from checks.mapping import sql_views
from checks.queries import SITES, YEAR

_STAR = ("fait_mission", "fait_materiel", "dim_personnel", "dim_materiel", "dim_mission")
_EUROPE = "('paris', 'london', 'berlin')"


def _with(views: tuple[str, ...], *more: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([sql_views(*views), *more]) + "\n"


def _days(column: str, start: str, end: str) -> str:
    return f"{column} BETWEEN DATE '{YEAR}-{start}' AND DATE '{YEAR}-{end}'"


M = "fait_mission f JOIN dim_mission m ON f.ID_MISSION = m.ID_MISSION"
E = "fait_materiel f JOIN dim_materiel m ON f.ID_MATERIEL = m.ID_MATERIEL"
P = " JOIN dim_personnel p ON f.ID_PERSONNEL = p.ID_PERSONNEL"
T = "ROUND(SUM(m.IMPACT) / 1000, 6)"

QUESTIONS = {
    "q1": """SELECT COUNT(DISTINCT ID_PERSONNEL) AS nb_cadres FROM dim_personnel
        WHERE FONCTION_PERSONNEL = 'Cadre' AND lower(ID_SITE) = 'paris'""",
    "q2": """SELECT COUNT(DISTINCT ID_PERSONNEL) AS nb_data_engineers FROM dim_personnel
        WHERE lower(FONCTION_PERSONNEL) = 'ingénieur data'
        AND lower(ID_SITE) IN ('newyork', 'la')""",
    "q3": """SELECT COUNT(DISTINCT ID_PERSONNEL) AS nb_ingenieurs_info FROM dim_personnel
        WHERE lower(FONCTION_PERSONNEL) = 'ingénieur informaticien'""",
    "q4": f"""SELECT COUNT(f.ID_MATERIEL) AS nb_pc_fixes FROM {E}
        WHERE lower(m.TYPE) LIKE 'pc fixe%' AND {_days('f.ID_DATE_ACHAT', '06-01', '09-30')}""",
    "q5": f"""SELECT {T} AS impact_total_pc_fixes_tonnes FROM {E}
        WHERE lower(m.TYPE) = 'pc fixe sans ecran'
        AND {_days('f.ID_DATE_ACHAT', '05-01', '10-31')}""",
    "q6": f"""SELECT {T} AS impact_pc_portables_tonnes FROM {E} {P}
        WHERE lower(m.TYPE) = 'pc portable' AND lower(p.FONCTION_PERSONNEL) = 'ingénieur data'
        AND lower(f.ID_SITE) IN ('london', 'newyork')
        AND {_days('f.ID_DATE_ACHAT', '05-01', '10-31')}""",
    "q7": f"""SELECT {T} AS impact_ecrans_tonnes FROM {E} {P}
        WHERE lower(m.TYPE) = 'ecran' AND lower(p.FONCTION_PERSONNEL) = 'cadre'
        AND {_days('f.ID_DATE_ACHAT', '07-01', '09-30')}""",
    "q8": f"""SELECT {T} AS impact_missions_europe_tonnes FROM {M}
        WHERE lower(f.ID_SITE) IN {_EUROPE} AND {_days('f.ID_DATE_MISSION', '05-01', '10-31')}""",
    "q9": f"""SELECT f.ID_DATE_MISSION, {T} AS impact_journalier_tonnes FROM {M}
        WHERE lower(m.TRANSPORT) = 'avion' AND lower(f.ID_SITE) IN {_EUROPE}
        GROUP BY 1 ORDER BY SUM(m.IMPACT) DESC NULLS LAST, 1 LIMIT 5""",
    "q10": f"""SELECT FONCTION_PERSONNEL, ROUND(SUM(IMPACT) / 1000, 6) AS impact_total_tonnes FROM (
            SELECT p.FONCTION_PERSONNEL, m.IMPACT FROM {M} {P}
            UNION ALL SELECT p.FONCTION_PERSONNEL, m.IMPACT FROM {E} {P})
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
    "q11": f"""SELECT ID_SITE, ROUND(SUM(IMPACT) / 1000, 6) AS impact_total_tonnes FROM (
            SELECT f.ID_SITE, m.IMPACT FROM {M} UNION ALL SELECT f.ID_SITE, m.IMPACT FROM {E})
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
    "q12": f"""SELECT {T} AS impact_inter_sites_tonnes FROM {M}
        WHERE {_days('f.ID_DATE_MISSION', '09-01', '09-30')}
        AND lower(m.VILLE_DESTINATION) IN (SELECT DISTINCT lower(ID_SITE) FROM dim_personnel)""",
    "q12b": f"""SELECT {T} AS impact_inter_sites_tonnes FROM {M}
        WHERE {_days('f.ID_DATE_MISSION', '09-01', '09-30')}
        AND CASE lower(m.VILLE_DESTINATION) WHEN 'new-york' THEN 'newyork'
            WHEN 'new york' THEN 'newyork' WHEN 'los angeles' THEN 'la'
            ELSE lower(m.VILLE_DESTINATION) END
            IN (SELECT DISTINCT lower(ID_SITE) FROM dim_personnel)""",
    "q13": f"""SELECT {T} AS impact_conferences_tonnes FROM {M}
        WHERE lower(m.TYPE_MISSION) = 'conférence' AND lower(f.ID_SITE) = 'la'
        AND {_days('f.ID_DATE_MISSION', '07-01', '07-31')}""",
    "q14": f"""SELECT p.FONCTION_PERSONNEL, {T} AS impact_total_tonnes FROM {M} {P}
        WHERE lower(m.TYPE_MISSION) = 'conférence'
        AND {_days('f.ID_DATE_MISSION', '05-01', '09-30')}
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
    "q15": f"""SELECT ROUND(AVG(date_diff('day', p.DT_NAISS, f.ID_DATE_MISSION)
            / CAST(365.25 AS DOUBLE)), 6) AS age_moyen FROM {M} {P}
        WHERE lower(p.FONCTION_PERSONNEL) = 'ingénieur data' AND lower(m.TYPE_MISSION) = 'formation'
        AND {_days('f.ID_DATE_MISSION', '07-01', '09-30')}""",
    "q16": f"""SELECT m.VILLE_DESTINATION, {T} AS impact_cumule_tonnes FROM {M}
        WHERE {_days('f.ID_DATE_MISSION', '05-01', '10-31')}
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 1""",
    "q17": f"""SELECT m.TYPE_MISSION, {T} AS impact_total_tonnes FROM {M} {P}
        WHERE lower(p.FONCTION_PERSONNEL) = 'cadre' AND lower(f.ID_SITE) IN {_EUROPE}
        AND {_days('f.ID_DATE_MISSION', '05-01', '05-31')}
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 3""",
    "q18": f"""SELECT m.ID_MISSION, m.TYPE_MISSION, m.VILLE_DESTINATION, {T} AS impact_total_tonnes,
            m.ID_MISSION || ' (' || m.TYPE_MISSION || ' -> ' || m.VILLE_DESTINATION || ')' AS "Label"
        FROM {M} WHERE lower(f.ID_SITE) = 'paris'
        GROUP BY 1, 2, 3 ORDER BY 4 DESC NULLS LAST, 1, 2, 3 LIMIT 5""",
    "q19": f"""SELECT strftime(f.ID_DATE_MISSION, '%Y-%m') AS "Mois", m.TRANSPORT,
            f.ID_SITE AS "Site", {T} AS impact_total_tonnes FROM {M} GROUP BY 1, 2, 3""",
    "q20": f"""SELECT strftime(f.ID_DATE_MISSION, '%Y-%m') AS "Mois", 'Missions' AS "Categorie",
            {T} AS impact_tonnes FROM {M} GROUP BY 1
        UNION ALL SELECT strftime(f.ID_DATE_ACHAT, '%Y-%m'), 'Matériel Informatique', {T}
        FROM {E} GROUP BY 1""",
}

# ── Panels ──

_WIDE = (
    """trips AS (SELECT f.*, m.* EXCLUDE (ID_MISSION, TRANSPORT), p.FONCTION_PERSONNEL,
        COALESCE(m.TRANSPORT, 'Non renseigné') AS "TRANSPORT", f.ID_DATE_MISSION AS "DATE",
        COALESCE(m.IMPACT, 0) / 1000 AS "tCO2e", strftime(f.ID_DATE_MISSION, '%Y-%m') AS "MOIS",
        COALESCE(m.VILLE_DESTINATION, '?') || ' (' || COALESCE(m.PAYS_DESTINATION, '?') || ')'
            AS "DESTINATION"
        FROM fait_mission f LEFT JOIN dim_mission m ON f.ID_MISSION = m.ID_MISSION
        LEFT JOIN dim_personnel p ON f.ID_PERSONNEL = p.ID_PERSONNEL)""",
    """goods AS (SELECT f.*, m.* EXCLUDE (ID_MATERIEL, TYPE), p.FONCTION_PERSONNEL,
        COALESCE(m.TYPE, 'Non renseigné') AS "TYPE", f.ID_DATE_ACHAT AS "DATE",
        COALESCE(m.IMPACT, 0) / 1000 AS "tCO2e", strftime(f.ID_DATE_ACHAT, '%Y-%m') AS "MOIS"
        FROM fait_materiel f LEFT JOIN dim_materiel m ON f.ID_MATERIEL = m.ID_MATERIEL
        LEFT JOIN dim_personnel p ON f.ID_PERSONNEL = p.ID_PERSONNEL)""",
)
_IN_PERIOD = f""""DATE" >= DATE '{YEAR}-05-01' AND "DATE" < DATE '{YEAR}-11-01'"""
_BOTH = f"""both_kinds AS (
    SELECT 'mission' AS source, ID_SITE, ID_PERSONNEL, FONCTION_PERSONNEL, "tCO2e"
        FROM trips WHERE {_IN_PERIOD}
    UNION ALL SELECT 'materiel', ID_SITE, ID_PERSONNEL, FONCTION_PERSONNEL, "tCO2e"
        FROM goods WHERE {_IN_PERIOD})"""
_SUM = 'ROUND(SUM("tCO2e"), 6) AS "tCO2e"'
_FMT = "format('{:,.2f}', CAST(SUM(\"tCO2e\") AS DOUBLE))"
_SECTORS = """(VALUES ('Ingénieur Data', 1), ('Ingénieur Informaticien', 2), ('Cadre', 3),
    ('Economiste', 4), ('DRH', 5)) AS s(FONCTION_PERSONNEL, place)"""


def _kpi(source: str) -> str:
    return f"""COALESCE(SUM("tCO2e") FILTER (source = '{source}'), 0)"""


def _text(tonnes: str) -> str:
    return f"format('{{:,.2f}}', CAST({tonnes} AS DOUBLE))"


_SITE_SUMS = ", ".join(
    f"""ROUND(COALESCE(SUM("tCO2e") FILTER (ID_SITE = '{s}'), 0), 6) AS "{s}\"""" for s in SITES
)

PANELS = {
    "panel_trips_wide": """SELECT * EXCLUDE ("tCO2e"), ROUND("tCO2e", 6) AS "tCO2e" FROM trips""",
    "panel_equipment_wide":
        """SELECT * EXCLUDE ("tCO2e"), ROUND("tCO2e", 6) AS "tCO2e" FROM goods""",
    "panel_kpis": f"""SELECT ROUND({_kpi('mission')} + {_kpi('materiel')}, 6) AS total,
        ROUND({_kpi('mission')}, 6) AS missions, ROUND({_kpi('materiel')}, 6) AS materiel,
        {_text(f"{_kpi('mission')} + {_kpi('materiel')}")} AS total_texte,
        {_text(_kpi('mission'))} AS missions_texte, {_text(_kpi('materiel'))} AS materiel_texte
        FROM both_kinds""",
    "panel_by_site": f"SELECT ID_SITE, {_SUM} FROM both_kinds GROUP BY 1",
    "panel_split": f"""SELECT 'Missions' AS source, ROUND(greatest({_kpi('mission')}, 0), 6) AS "tCO2e"
        FROM both_kinds UNION ALL SELECT 'Matériel informatique',
        ROUND(greatest({_kpi('materiel')}, 0), 6) FROM both_kinds""",
    "panel_filter_options": " UNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS field, {c} AS value FROM trips
        WHERE {_IN_PERIOD} AND {c} IS NOT NULL""" for c in ("ID_SITE", "TYPE_MISSION", "TRANSPORT")
    ),
    "panel_monthly_trips": f"""SELECT "MOIS", {_SUM} FROM trips
        WHERE ID_SITE = 'Paris' AND TYPE_MISSION = 'Formation' GROUP BY 1""",
    "panel_by_transport": f"""SELECT TRANSPORT, {_SUM}, {_FMT} AS label FROM trips
        WHERE ID_SITE = 'LA' GROUP BY 1 HAVING SUM("tCO2e") > 0""",
    "panel_top_trips": """SELECT ID_MISSION, VILLE_DEPART || ' → ' || VILLE_DESTINATION AS route,
        strftime("DATE", '%d/%m/%Y') AS jour, ROUND("tCO2e", 6) AS "tCO2e",
        format('{:,.2f}', "tCO2e") || ' tCO2e' AS label,
        CAST(length(VILLE_DEPART || ' → ' || VILLE_DESTINATION) AS INTEGER) AS route_len
        FROM trips WHERE "tCO2e" > 0 ORDER BY trips."tCO2e" DESC, ID_MISSION LIMIT 10""",
    "panel_equipment_by_type": f"""SELECT TYPE, {_SUM}, {_FMT} AS label FROM goods
        WHERE {_IN_PERIOD} GROUP BY 1 HAVING SUM("tCO2e") > 0""",
    "panel_equipment_by_site": f"""SELECT ID_SITE, {_SUM}, {_FMT} AS label FROM goods
        WHERE {_IN_PERIOD} GROUP BY 1 HAVING SUM("tCO2e") > 0""",
    "panel_monthly_equipment": f"""SELECT "MOIS", {_SUM} FROM goods GROUP BY 1""",
    "panel_missing_impact": """SELECT
        ROUND(100.0 * COUNT(*) FILTER (IMPACT IS NULL) / COUNT(*), 6) AS missing_pct,
        100.0 * COUNT(*) FILTER (IMPACT IS NULL) / COUNT(*) > 5 AS alert FROM dim_materiel""",
    "panel_by_sector": f"""SELECT s.FONCTION_PERSONNEL, {_SUM} FROM {_SECTORS}
        JOIN both_kinds b ON s.FONCTION_PERSONNEL = b.FONCTION_PERSONNEL
        GROUP BY 1 HAVING SUM("tCO2e") > 0""",
    "panel_sector_site_matrix": f"""SELECT FONCTION_PERSONNEL, {_SITE_SUMS} FROM both_kinds
        WHERE FONCTION_PERSONNEL IS NOT NULL AND ID_SITE IS NOT NULL GROUP BY 1""",
    "panel_top_emitters": f"""SELECT ID_PERSONNEL, {_SUM} FROM both_kinds GROUP BY 1
        ORDER BY SUM(both_kinds."tCO2e") DESC, 1 LIMIT 10""",
    "panel_date_range": """SELECT MIN(d) AS date_min, MAX(d) AS date_max FROM (
        SELECT "DATE" AS d FROM trips UNION ALL SELECT "DATE" FROM goods)""",
}
PANELS["panel_top_trips_resent"] = PANELS["panel_top_trips"]

# ── Enrichment ──

_KINDS = {
    "Konferenz": "Conférence", "Conference": "Conférence", "Schulung": "Formation",
    "Vocational Training": "Formation", "Meeting": "Réunion", "Team Meeting": "Réunion",
    "Geschäftstreffen": "Rencontre entreprises", "Business Meeting": "Rencontre entreprises",
    "Entwicklung": "Développement", "Development": "Développement",
}
_KIND_CASE = (
    "CASE TYPE_MISSION "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _KINDS.items())
    + " ELSE TYPE_MISSION END"
)
_FOLDED = "replace(replace(lower(trim(MODELE)), 'è', 'e'), 'é', 'e')"
_IMPACT_VIEWS = (
    f"""ref AS (SELECT trim(TYPE) AS t, NULLIF(trim(MODELE), '') AS mo,
        {_FOLDED} = 'modele par defaut' AS is_default, TRY_CAST(IMPACT AS DOUBLE) AS i, _position
        FROM impacts)""",
    """by_model AS (SELECT mo AS MODELE, arg_min(i, _position) AS IMPACT FROM ref
        WHERE NOT is_default AND mo IS NOT NULL GROUP BY 1)""",
    """by_type AS (SELECT t AS TYPE, arg_min(i, _position) AS IMPACT FROM ref
        WHERE is_default AND t IS NOT NULL GROUP BY 1)""",
)
_GOODS = (
    *_IMPACT_VIEWS,
    """uniq AS (SELECT * EXCLUDE (load_order), MIN(load_order) AS load_order
        FROM raw_equipment GROUP BY ALL)""",
    """bought AS (SELECT u.ID_MATERIELINFO AS "ID_MATERIEL", u.ID_PERSONNEL,
        CAST(TRY_CAST(u.DATE_ACHAT AS TIMESTAMP) AS DATE) AS "ID_DATE_ACHAT",
        NULLIF(trim(u.TYPE), '') AS "TYPE", NULLIF(trim(u.MODELE), '') AS "MODELE",
        ingest_date, site_dir, load_order,
        NULLIF(split_part(u.ID_PERSONNEL, '_', 2), '') AS "ID_SITE" FROM uniq u)""",
    f"""materiel AS (SELECT b.*, CASE
            WHEN {_FOLDED.replace('MODELE', 'b.MODELE')} = 'modele par defaut' AND b.TYPE IS NULL
                THEN 350.0::DOUBLE
            WHEN {_FOLDED.replace('MODELE', 'b.MODELE')} = 'modele par defaut' OR b.MODELE IS NULL
                THEN t.IMPACT
            ELSE m.IMPACT END AS "IMPACT"
        FROM bought b LEFT JOIN by_model m ON b.MODELE = m.MODELE
        LEFT JOIN by_type t ON COALESCE(b.TYPE, '') = t.TYPE)""",
)
_GOODS_BASE = ("impacts", "raw_equipment")

_FACTORS = (
    "f AS (SELECT *, TRY_CAST(total AS DOUBLE) AS v FROM transports)",
    "c AS (SELECT *, TRY_CAST(total AS DOUBLE) AS v FROM cars)",
    """bands AS (
        SELECT 'short_haul' AS "BAND", 'AVION' AS "CODE", NULL::DOUBLE AS "LO", FALSE AS "LO_IN",
            1000.0::DOUBLE AS "HI", FALSE AS "HI_IN",
            (SELECT arg_min(v, _position) FROM f WHERE subsubcategory LIKE '%Short haul%') AS "FACTOR"
        UNION ALL SELECT 'medium_haul', 'AVION', 1000, TRUE, 3500, TRUE,
            (SELECT arg_min(v, _position) FROM f WHERE subsubcategory LIKE '%Medium haul%')
        UNION ALL SELECT 'long_haul', 'AVION', 3500, FALSE, NULL, FALSE,
            (SELECT arg_min(v, _position) FROM f WHERE subsubcategory LIKE '%Long haul%')
        UNION ALL SELECT 'short_train', 'TRAIN', NULL, FALSE, 200, TRUE,
            (SELECT arg_min(v, _position) FROM f WHERE subsubcategory LIKE '%Train < 200%')
        UNION ALL SELECT 'long_train', 'TRAIN', 200, FALSE, NULL, FALSE,
            (SELECT arg_min(v, _position) FROM f WHERE subsubcategory LIKE '%TGV > 200%')
        UNION ALL SELECT 'car', 'TAXI', NULL, FALSE, NULL, FALSE,
            (SELECT AVG(v) FROM c WHERE subcategory = 'Car')
        UNION ALL SELECT 'bus', 'TC', NULL, FALSE, NULL, FALSE,
            (SELECT AVG(v) FROM f WHERE subcategory = 'Bus'))""",
)


def _factor(transport: str, km: str) -> str:
    """Factor by nested conditions instead of a band join."""

    def of(band: str) -> str:
        return f"""(SELECT ROUND("FACTOR", 6) FROM bands WHERE "BAND" = '{band}')"""

    code = f"lower(trim({transport}))"
    return f"""CASE WHEN {km} IS NULL THEN NULL
        WHEN {code} IN ('avion', 'plane', 'airplane') THEN CASE WHEN {km} < 1000 THEN {of('short_haul')}
            WHEN {km} <= 3500 THEN {of('medium_haul')} ELSE {of('long_haul')} END
        WHEN {code} = 'train' THEN CASE WHEN {km} <= 200 THEN {of('short_train')}
            ELSE {of('long_train')} END
        WHEN {code} = 'taxi' THEN {of('car')}
        WHEN {code} IN ('transports en commun', 'public transport') THEN {of('bus')} END"""


_TWICE = "CASE WHEN lower(ALLER_RETOUR) IN ('oui', 'yes') THEN 2 ELSE 1 END"
_KEYS = "VILLE_DEPART, PAYS_DEPART, VILLE_DESTINATION, PAYS_DESTINATION"
_PAIRS = (
    """pairs AS (SELECT DISTINCT trim(VILLE_DEPART) AS "VILLE_DEPART", PAYS_DEPART,
        VILLE_DESTINATION, PAYS_DESTINATION FROM raw_trips)"""
)


def _haversine(a: str, b: str) -> str:
    lat1, lon1, lat2, lon2 = f"{a}.LAT", f"{a}.LON", f"{b}.LAT", f"{b}.LON"
    h = f"""(pow(sin(radians({lat2} - {lat1}) / 2), 2)
        + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"""
    return f"ROUND(2 * 6371.0088 * asin(CASE WHEN {h} > 1 THEN 1 ELSE sqrt({h}) END), 2)"


_SAME = "p.VILLE_DEPART = p.VILLE_DESTINATION AND p.PAYS_DEPART = p.PAYS_DESTINATION"
_ENDS = """{how} JOIN coordinates a ON a.VILLE = p.VILLE_DEPART AND a.PAYS = p.PAYS_DEPART
    {how} JOIN coordinates b ON b.VILLE = p.VILLE_DESTINATION AND b.PAYS = p.PAYS_DESTINATION"""


def _distance(km: str) -> str:
    return f"CASE WHEN {_SAME} THEN 8.0::DOUBLE ELSE {km} END AS \"DISTANCE_KM\""


_COMPUTED = f"""computed AS (SELECT p.*, {_distance(_haversine('a', 'b'))}
    FROM pairs p {_ENDS.format(how='LEFT')})"""
_KNOWN = f"known AS (SELECT DISTINCT {_KEYS}, DISTANCE_KM FROM known_distances WHERE DISTANCE_KM IS NOT NULL)"
_ADDED = f"""added AS (SELECT c.* FROM computed c ANTI JOIN known k USING ({_KEYS})
    WHERE c.DISTANCE_KM IS NOT NULL)"""
_TRIPS = (
    *_FACTORS, _PAIRS, _COMPUTED, _KNOWN, _ADDED,
    "dist AS (SELECT * FROM known UNION ALL SELECT * FROM added)",
    f"""cleaned AS (SELECT r.ID_MISSION, r.ID_PERSONNEL,
        CAST(TRY_CAST(r.DATE_MISSION AS TIMESTAMP) AS DATE) AS "ID_DATE_MISSION",
        {_KIND_CASE} AS "TYPE_MISSION", trim(r.VILLE_DEPART) AS "VILLE_DEPART", r.PAYS_DEPART,
        r.VILLE_DESTINATION, r.PAYS_DESTINATION, r.TRANSPORT, r.ALLER_RETOUR,
        r.ingest_date, r.site_dir, r.load_order, split_part(r.ID_PERSONNEL, '_', 2) AS "ID_SITE"
        FROM raw_trips r)""",
    f"""located AS (SELECT c.*, d.DISTANCE_KM FROM cleaned c LEFT JOIN dist d USING ({_KEYS}))""",
    f"""mission AS (SELECT *, {_factor('TRANSPORT', 'DISTANCE_KM')} AS "CO2EQ",
        round_even(DISTANCE_KM * ({_factor('TRANSPORT', 'DISTANCE_KM')}) * ({_TWICE}) * 10000.0::DOUBLE, 0)
            / 10000 AS "IMPACT" FROM located)""",
)
_TRIPS_BASE = ("raw_trips", "coordinates", "known_distances", "transports", "cars")

# Vincenty's inverse formula as a recursive query: one step per level.
_A, _F = "6378.137", "(1 / 298.257223563)"
_ELLIPSOID = (
    _PAIRS,
    f"""ends AS (SELECT p.*, {_SAME} AS same_place,
        atan((1 - {_F}) * tan(radians(a.LAT))) AS u1, atan((1 - {_F}) * tan(radians(b.LAT))) AS u2,
        radians(((b.LON - a.LON + 540.0) % 360.0) - 180.0) AS d, {_haversine('a', 'b')} AS sphere
        FROM pairs p {_ENDS.format(how='INNER')})""",
    f"""steps AS (
        SELECT *, d AS lam, 0 AS n FROM ends
        UNION ALL
        SELECT * EXCLUDE (lam, n, s, c, ss, cs, sa, c2a, c2m, cc),
            d + (1 - cc) * {_F} * sa * (atan2(ss, cs) + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))),
            n + 1
        FROM (SELECT *, {_F} / 16 * c2a * (4 + {_F} * (4 - 3 * c2a)) AS cc FROM (
            SELECT *, CASE WHEN c2a < 1e-15 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / c2a END AS c2m FROM (
            SELECT *, 1 - sa * sa AS c2a FROM (
            SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * s / ss END AS sa FROM (
            SELECT *, sqrt(pow(cos(u2) * s, 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * c, 2)) AS ss,
                sin(u1) * sin(u2) + cos(u1) * cos(u2) * c AS cs FROM (
            SELECT *, sin(lam) AS s, cos(lam) AS c FROM steps WHERE n < 60))))))
    )""",
    f"""last_step AS (SELECT *, sqrt(pow(cos(u2) * sin(lam), 2)
            + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
            sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM steps WHERE n = 60)""",
    """angles AS (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa
        FROM last_step)""",
    f"""squares AS (SELECT *, (1 - sa * sa) * (1 / pow(1 - {_F}, 2) - 1) AS usq,
        CASE WHEN 1 - sa * sa < 1e-15 THEN 0
            ELSE cs - 2 * sin(u1) * sin(u2) / (1 - sa * sa) END AS c2m FROM angles)""",
    """series AS (SELECT *, 1 + usq / 16384 * (4096 + usq * (usq * (320 - 175 * usq) - 768)) AS ba,
        usq / 1024 * (256 + usq * (usq * (74 - 47 * usq) - 128)) AS bb FROM squares)""",
    f"""ellipsoid AS (SELECT *, {_A} * (1 - {_F}) * ba * (atan2(ss, cs) - bb * ss * (c2m + bb / 4
        * (cs * (2 * c2m * c2m - 1) - bb / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3))))
        AS km FROM series)""",
)

ENRICHMENT = {
    "personnel_dimension": _with(("raw_personnel",)) + """SELECT ID_PERSONNEL,
        CASE FONCTION_PERSONNEL WHEN 'Dateningenieur' THEN 'Ingénieur Data'
            WHEN 'Computer Engineer' THEN 'Ingénieur Informaticien' WHEN 'Führungskraft' THEN 'Cadre'
            WHEN 'HRD' THEN 'DRH' ELSE FONCTION_PERSONNEL END AS FONCTION_PERSONNEL,
        split_part(ID_PERSONNEL, '_', 2) AS ID_SITE, CAST(DT_NAISS AS DATE) AS DT_NAISS
        FROM raw_personnel QUALIFY row_number() OVER (PARTITION BY ID_PERSONNEL ORDER BY load_order) = 1""",
    "impact_by_model": _with(("impacts",), *_IMPACT_VIEWS) + "SELECT * FROM by_model",
    "impact_by_type": _with(("impacts",), *_IMPACT_VIEWS) + "SELECT * FROM by_type",
    "equipment_impact": _with(_GOODS_BASE, *_GOODS)
    + 'SELECT "TYPE", "MODELE", "IMPACT", COUNT(*) AS n FROM materiel GROUP BY ALL',
    "clean_equipment": _with(_GOODS_BASE, *_GOODS) + "SELECT * FROM materiel",
    "transport_factors": _with(("transports", "cars"), *_FACTORS)
    + 'SELECT * REPLACE (ROUND("FACTOR", 6) AS "FACTOR") FROM bands',
    "trip_impact": _with(
        ("raw_trips", "transports", "cars"), *_FACTORS,
        """t AS (SELECT ID_MISSION, TRANSPORT, ALLER_RETOUR,
            100.0::DOUBLE * (CAST(ID_MISSION AS BIGINT) % 60) AS "DISTANCE_KM" FROM raw_trips)""",
    ) + f"""SELECT *, {_factor('TRANSPORT', 'DISTANCE_KM')} AS "CO2EQ",
        ROUND(DISTANCE_KM * ({_factor('TRANSPORT', 'DISTANCE_KM')}) * ({_TWICE}), 4) AS "IMPACT" FROM t""",
    "distance_of_pairs": _with(
        ("known_distances", "coordinates"),
        f"pairs AS (SELECT DISTINCT {_KEYS} FROM known_distances)", _COMPUTED,
    ) + "SELECT * FROM computed",
    "missing_distances": _with(
        ("raw_trips", "coordinates", "known_distances"), _PAIRS, _COMPUTED, _KNOWN, _ADDED
    ) + "SELECT * FROM added",
    "missing_distances_ellipsoid": _with(
        ("raw_trips", "coordinates", "known_distances"), *_ELLIPSOID, _KNOWN
    ) + f"""SELECT {_KEYS}, CASE WHEN same_place THEN 8.0::DOUBLE ELSE ROUND(km, 2) END AS "DISTANCE_KM"
        FROM ellipsoid ANTI JOIN known USING ({_KEYS})
        WHERE km IS NOT NULL""",
    "distance_reference": _with(("raw_trips", "coordinates"), _PAIRS)
    + f"SELECT p.*, {_distance(_haversine('a', 'b'))} FROM pairs p {_ENDS.format(how='INNER')}",
    "distance_reference_ellipsoid": _with(("raw_trips", "coordinates"), *_ELLIPSOID)
    + f"""SELECT {_KEYS}, CASE WHEN same_place THEN 8.0::DOUBLE ELSE ROUND(km, 2) END AS "DISTANCE_KM"
        FROM ellipsoid""",
    "unlocated_places": _with(("raw_trips", "coordinates")) + """SELECT * FROM (
        SELECT trim(VILLE_DEPART) AS "VILLE", PAYS_DEPART AS "PAYS" FROM raw_trips
        UNION SELECT VILLE_DESTINATION, PAYS_DESTINATION FROM raw_trips)
        ANTI JOIN coordinates USING (VILLE, PAYS)""",
    "clean_trips": _with(_TRIPS_BASE, *_TRIPS) + "SELECT * FROM mission",
    "load_quality": _with((*_TRIPS_BASE, *_GOODS_BASE), *_TRIPS, *_GOODS) + """
        SELECT 'mission' AS table_name, ingest_date, site_dir, COUNT(*) AS n_rows,
            COUNT(*) FILTER (ID_SITE IS NULL) AS "missing_ID_SITE",
            COUNT(*) FILTER (DISTANCE_KM IS NULL) AS "missing_DISTANCE_KM",
            COUNT(*) FILTER (IMPACT IS NULL) AS "missing_IMPACT",
            ROUND(100.0 * COUNT(*) FILTER (IMPACT IS NULL) / COUNT(*), 6) AS missing_impact_pct
        FROM mission GROUP BY ALL
        UNION ALL SELECT 'materiel', ingest_date, site_dir, COUNT(*),
            COUNT(*) FILTER (ID_SITE IS NULL), NULL, COUNT(*) FILTER (IMPACT IS NULL),
            ROUND(100.0 * COUNT(*) FILTER (IMPACT IS NULL) / COUNT(*), 6)
        FROM materiel GROUP BY ALL""",
}

# ── Loading ──


def _ranked(source: str, pk: str, columns: str, order: str) -> str:
    return f"""SELECT ingest_date, load_order, {columns} FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {pk} ORDER BY {order}) = 1"""


_BUY = "ID_MATERIEL, TYPE, MODELE, IMPACT"
_USER = "user_id, event_type, value"
_EVENT_FACTS = """facts AS (SELECT ingest_date, user_id, event_type, MIN(load_order) AS load_order
    FROM event_log GROUP BY 1, 2, 3)"""

LOADING = {
    "equipment_snapshot": _with(_GOODS_BASE, *_GOODS)
    + _ranked("materiel", "ID_MATERIEL", _BUY, "ingest_date DESC, load_order DESC"),
    "equipment_delta": _with(_GOODS_BASE, *_GOODS)
    + _ranked("materiel", "ID_MATERIEL", _BUY, "ingest_date, load_order DESC"),
    "equipment_fact_rows": _with(_GOODS_BASE, *_GOODS) + """SELECT ingest_date, ID_PERSONNEL,
        ID_MATERIEL, ID_SITE, ID_DATE_ACHAT, MIN(load_order) AS load_order FROM materiel GROUP BY ALL""",
    "user_delta": _with(("event_log",))
    + _ranked("event_log", "user_id", _USER, "ingest_date, load_order DESC"),
    "distinct_file_rows": _with(("raw_equipment",)) + """SELECT 'b' AS ID_MATERIELINFO, site_dir AS ID_PERSONNEL,
        DATE_ACHAT, TYPE, MODELE, ingest_date, site_dir, min(load_order) AS load_order
        FROM raw_equipment GROUP BY DATE_ACHAT, TYPE, MODELE, ingest_date, site_dir, right(PRENOM_PERSONNEL, 1)""",
    "repaired_user_deltas": _with(("event_log",))
    + _ranked("event_log", "user_id", _USER, "ingest_date, load_order DESC"),
    "user_delta_of_days": _with(("event_log",)) + f"""SELECT ingest_date, load_order, {_USER}
        FROM event_log e WHERE ingest_date >= DATE '2024-01-02' AND NOT EXISTS (
            SELECT 1 FROM event_log o WHERE o.user_id = e.user_id AND o.ingest_date < e.ingest_date)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingest_date, load_order DESC) = 1""",
    "user_snapshot": _with(("event_log",))
    + _ranked("event_log", "user_id", _USER, "ingest_date DESC, load_order DESC"),
    "daily_fact_rows": _with(("event_log",), _EVENT_FACTS) + "SELECT * FROM facts",
    "rebuilt_from_days": _with(("event_log",), _EVENT_FACTS)
    + _ranked("facts", "user_id", "user_id, event_type", "ingest_date DESC, load_order DESC"),
    "days_with_data": "SELECT DISTINCT CAST(ts AS DATE) AS ingest_date FROM events",
}

# ── Operators ──

_PERSONS = """SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS person, o_totalprice AS amount
    FROM orders UNION ALL SELECT user_id, value FROM events"""
_ADD = f"SELECT person, ROUND(SUM(amount), 2) AS amount FROM ({_PERSONS}) GROUP BY 1"
_ITEM = """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) = 1"""

OPERATORS = {
    "schema_contract": "SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus FROM orders",
    "header_cleaning": """SELECT s_suppkey AS "S_SUPPKEY", s_name AS "S_NEME",
        s_nationkey AS "S_NATIONKEY", s_acctbal AS "S_ACCTBAL" FROM supplier""",
    "period_and_filters": f"""SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day
        FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{YEAR}-01-01'
        AND DATE '{YEAR}-12-31' AND o_orderstatus = 'F'""",
    "prefix_in_and_positive": """SELECT p_partkey, p_type, p_brand FROM part
        WHERE lower(p_type) LIKE 's%' AND lower(p_brand) IN ('brand#1', 'brand#12', 'brand#23')
        AND p_retailprice > 0""",
    "semi_join_in": """SELECT c_nationkey, COUNT(*) AS n FROM customer
        WHERE c_nationkey IN (SELECT s_nationkey FROM supplier) GROUP BY 1""",
    "anti_join_unseen": """SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "left_star": """SELECT o_orderkey, COUNT(l_linenumber) AS n_lines,
        ROUND(COALESCE(SUM(l_quantity), 0), 2) AS quantity
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "reconciled_site": _with(("fait_mission",)) + """SELECT ID_MISSION,
        CASE WHEN ID_SITE <> 'Paris' THEN ID_SITE ELSE '?' END AS "ID_SITE" FROM fait_mission""",
    "derived_site": _with(("fait_mission",)) + """SELECT ID_MISSION, ID_PERSONNEL,
        split_part(ID_PERSONNEL, '_', 2) AS "ID_SITE" FROM fait_mission""",
    "outer_add": _ADD,
    "outer_add_by_join": _ADD,
    "group_total_null_key": """SELECT NULLIF(o_orderstatus, 'P') AS status,
        ROUND(SUM(o_totalprice), 2) AS o_totalprice FROM orders GROUP BY 1""",
    "pivot_matrix": "SELECT o_orderpriority, " + ", ".join(
        f"""ROUND(COALESCE(SUM(o_totalprice) FILTER (o_orderstatus = '{s}'), 0), 2) AS "{s}\""""
        for s in "FOP") + " FROM orders GROUP BY 1",
    "ordered_by_list": """SELECT o_orderpriority, COUNT(*) AS n,
        CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '9-NONE' THEN 3
            ELSE 99 END AS INTEGER) AS place FROM orders GROUP BY 1""",
    "reindexed_to_list": """SELECT v AS o_orderpriority,
        CAST((SELECT COUNT(*) FROM orders WHERE o_orderpriority = v) AS DOUBLE) AS n
        FROM (VALUES ('3-MEDIUM'), ('1-URGENT'), ('9-NONE')) t(v)""",
    "first_item_of_order": _ITEM.format(order="l_shipdate, l_linenumber, l_partkey, l_suppkey"),
    "last_item_of_order": _ITEM.format(
        order="l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"),
    "top_orders": """SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "sorted_options": "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL",
    "day_bounds": """SELECT CAST(MIN(d) AS DATE) AS date_min, CAST(MAX(d) AS DATE) AS date_max FROM (
        SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)""",
    "value_bounds": """SELECT MIN(o_totalprice) AS min_value, MAX(o_totalprice) AS max_value
        FROM orders""",
    "load_counts": _with(("dim_mission",)) + """SELECT TYPE_MISSION, COUNT(*) AS n_rows,
        COUNT(*) FILTER (TRANSPORT IS NULL) AS "missing_TRANSPORT",
        COUNT(*) FILTER (PAYS_DESTINATION IS NULL) AS "missing_PAYS_DESTINATION",
        COUNT(*) FILTER (IMPACT IS NULL) AS "missing_IMPACT" FROM dim_mission GROUP BY 1""",
    "distinct_places": _with(("dim_mission",)) + """SELECT VILLE_DEPART AS "VILLE",
        PAYS_DEPART AS "PAYS" FROM dim_mission
        UNION SELECT VILLE_DESTINATION, PAYS_DESTINATION FROM dim_mission""",
    "tagged_union": """SELECT 'orders' AS source, COUNT(*) AS n, COUNT(o_totalprice) AS n_price,
        CAST(0 AS BIGINT) AS n_quantity, COUNT(DISTINCT o_orderkey) AS n_keys FROM orders
        UNION ALL SELECT 'lineitem', COUNT(*), 0, COUNT(l_quantity), COUNT(DISTINCT l_orderkey)
        FROM lineitem""",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem",
    "translated_values": """SELECT CASE event_type WHEN 'click' THEN 'clic' WHEN 'view' THEN 'vue'
        WHEN 'purchase' THEN 'achat' ELSE event_type END AS word, COUNT(*) AS n FROM events GROUP BY 1""",
    "text_functions": """SELECT c_custkey, split_part(c_name, '#', 2) AS number,
        CAST(NULL AS VARCHAR) AS no_such_part, c_mktsegment AS site, lower(c_mktsegment) AS low,
        upper(c_mktsegment) AS up, c_name AS stripped, CAST(NULL AS VARCHAR) AS blank,
        CASE WHEN c_custkey % 3 = 2 THEN c_name ELSE 'Non renseigné' END AS labelled,
        c_mktsegment <> 'BUILDING' AND contains(c_mktsegment, 'MACH') AS has_mach,
        c_custkey % 3 = 0 AS is_default, CAST(length(c_name) AS INTEGER) AS len FROM customer""",
    "date_functions": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
        strftime(o_orderdate, '%Y-%m') AS month,
        CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE '?' END AS label,
        CAST(CAST(o_orderdate AS DATE) + 1 AS DATE) AS next_day,
        ROUND(date_diff('day', DATE '1980-02-29', CAST(o_orderdate AS DATE))
            / CAST(365.25 AS DOUBLE), 6) AS years,
        CAST(o_orderdate AS DATE) AS file_day FROM orders""",
    "number_functions": """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k,
        CAST(NULL AS DOUBLE) AS not_a_number,
        round_even(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) / 8 * 100, 0) / 100
            AS half_even,
        value / 1000 AS tonnes, format('{:,.2f}', value * 1000) AS text FROM events""",
    "haversine": _with(("dim_mission", "coordinates")) + f"""SELECT DISTINCT
        m.VILLE_DEPART AS city_1, m.VILLE_DESTINATION AS city_2, {_haversine('a', 'b')} AS km
        FROM dim_mission m JOIN coordinates a ON a.VILLE = m.VILLE_DEPART
        JOIN coordinates b ON b.VILLE = m.VILLE_DESTINATION""",
}

_STAR_SQL = _with(_STAR)
_PANEL_SQL = _with(_STAR, *_WIDE, _BOTH)

ORACLES: dict[str, str] = {
    **{k: _STAR_SQL + v for k, v in QUESTIONS.items()},
    **{k: _PANEL_SQL + v for k, v in PANELS.items()},
    **ENRICHMENT,
    **LOADING,
    **OPERATORS,
}
