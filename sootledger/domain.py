"""Fixed values of the footprint domain.

Everything in this module is a fixed value: codes, labels, constants and word
lists that results depend on. No logic lives here.
"""

from __future__ import annotations

import datetime as dt

# Directory codes of the sites, in load order.
SITE_CODES = ("BERLIN", "LONDON", "LOSANGELES", "NEWYORK", "PARIS", "SHANGHAI")

# Site names as they appear in ID_SITE, and the European ones.
SITE_NAMES = ("Berlin", "London", "LA", "NewYork", "Paris", "Shanghai")
EUROPEAN_SITES = ("paris", "london", "berlin")
US_SITES = ("newyork", "la")

# City spellings that stand for a site under another name.
CITY_TO_SITE = {"new-york": "newyork", "new york": "newyork", "los angeles": "la"}

# Columns kept from each kind of drop file.
PERSONNEL_COLUMNS = ["ID_PERSONNEL", "FONCTION_PERSONNEL", "DT_NAISS", "TS_CREATION_PERSONNEL"]
EQUIPMENT_COLUMNS = ["ID_MATERIELINFO", "ID_PERSONNEL", "DATE_ACHAT", "TYPE", "MODELE"]
TRIP_COLUMNS = [
    "ID_MISSION",
    "ID_PERSONNEL",
    "DATE_MISSION",
    "TYPE_MISSION",
    "VILLE_DEPART",
    "PAYS_DEPART",
    "VILLE_DESTINATION",
    "PAYS_DESTINATION",
    "TRANSPORT",
    "ALLER_RETOUR",
]

# Key of the city-pair distance reference.
DISTANCE_KEYS = ["VILLE_DEPART", "PAYS_DEPART", "VILLE_DESTINATION", "PAYS_DESTINATION"]

# German and English wordings and their French equivalent.
TRANSLATIONS = {
    "Ökonom": "Economiste",
    "Führungskraft": "Cadre",
    "Personalleiter": "DRH",
    "Computeringenieur": "Ingénieur Informaticien",
    "Dateningenieur": "Ingénieur Data",
    "Economist": "Economiste",
    "Business Executive": "Cadre",
    "HRD": "DRH",
    "Computer Engineer": "Ingénieur Informaticien",
    "Data Engineer": "Ingénieur Data",
    "Geschäftstreffen": "Rencontre entreprises",
    "Konferenz": "Conférence",
    "Schulung": "Formation",
    "Meeting": "Réunion",
    "Entwicklung": "Développement",
    "Conference": "Conférence",
    "Vocational Training": "Formation",
    "Team Meeting": "Réunion",
    "Business Meeting": "Rencontre entreprises",
    "Development": "Développement",
}

# Lower-case transport wordings and their factor code.
TRANSPORT_CODES = {
    "avion": "AVION",
    "plane": "AVION",
    "airplane": "AVION",
    "train": "TRAIN",
    "taxi": "TAXI",
    "transports en commun": "TC",
    "public transport": "TC",
}

# Distance bands per transport code as
# (band, code, lower km, lower included, upper km, upper included); None = open.
DISTANCE_BANDS = [
    ("short_haul", "AVION", None, False, 1000.0, False),
    ("medium_haul", "AVION", 1000.0, True, 3500.0, True),
    ("long_haul", "AVION", 3500.0, False, None, False),
    ("short_train", "TRAIN", None, False, 200.0, True),
    ("long_train", "TRAIN", 200.0, False, None, False),
    ("car", "TAXI", None, False, None, False),
    ("bus", "TC", None, False, None, False),
]

# Text that identifies the factor row of a band, and the
# categories whose mean is the factor of the two bands without such a row.
BAND_ROW_TEXT = {
    "short_haul": "Short haul",
    "medium_haul": "Medium haul",
    "long_haul": "Long haul",
    "short_train": "Train < 200",
    "long_train": "TGV > 200",
}
CAR_CATEGORY = "Car"
BUS_CATEGORY = "Bus"

# Impact rules.
DEFAULT_MODEL = "modele par defaut"
UNTYPED_DEFAULT_IMPACT = 350.0
SAME_CITY_KM = 8.0
RETURN_TRIP_WORDS = ("oui", "yes")
KG_PER_TONNE = 1000.0

# Display orders and labels.
SECTOR_ORDER = ["Ingénieur Data", "Ingénieur Informaticien", "Cadre", "Economiste", "DRH"]
TRANSPORT_ORDER = ["Avion", "Train", "Taxi", "Transports en commun", "Non renseigné"]
MISSING_LABEL = "Non renseigné"
UNKNOWN_MARK = "?"
MISSING_ALERT_PERCENT = 5.0

# First and last day of the delivered history.
FIRST_DAY = dt.date(2026, 4, 29)
LAST_DAY = dt.date(2026, 11, 14)

# Cell texts that a delimited file uses for "no value".
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters removed from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
