"""Text functions. Inputs are columns or column names, results are columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sootledger import domain


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove all white space, not only blanks, from both ends."""
    return F.trim(_col(c), F.lit(domain.WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def na_to_null(c: Column | str) -> Column:
    """Cell texts that mean "no value" become NULL; blanks inside a text stay."""
    c = _col(c)
    return F.when(~c.isin(*domain.NA_TEXTS), c)


def has_text(c: Column | str) -> Column:
    return blank_to_null(c).isNotNull()


def contains_text(c: Column | str, text: str) -> Column:
    """Literal substring test; NULL counts as no match."""
    return F.coalesce(_col(c).contains(text), F.lit(False))


def is_default_model(c: Column | str) -> Column:
    text = strip(c)
    same_length = F.length(text) == len(domain.DEFAULT_MODEL)  # spares most rows the folding
    folded = F.translate(F.lower(text), "èé", "ee")
    return F.coalesce(same_length & (folded == domain.DEFAULT_MODEL), F.lit(False))


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def translate_values(c: Column | str, mapping: Mapping[str, str] = domain.TRANSLATIONS) -> Column:
    """Replace known values; unknown values and NULL stay as they are."""
    c = _col(c)
    return F.coalesce(F.try_element_at(_literal_map(mapping), c), c)


def transport_code(c: Column | str) -> Column:
    return F.try_element_at(_literal_map(domain.TRANSPORT_CODES), F.lower(strip(c)))


def return_multiplier(c: Column | str) -> Column:
    is_return = F.lower(_col(c)).isin(*domain.RETURN_TRIP_WORDS)
    return F.when(is_return, F.lit(2.0)).otherwise(F.lit(1.0))


def segment(c: Column | str, index: int, separator: str = "_") -> Column:
    """The index-th part of a separated text, NULL when there is none."""
    return F.get(F.split(_col(c), re.escape(separator)), index)


def site_of(id_personnel: Column | str) -> Column:
    return segment(id_personnel, 1)


def label_missing(c: Column | str, label: str = domain.MISSING_LABEL) -> Column:
    """Trimmed text, with NULL, blank, "nan" and "None" replaced by a label."""
    text = strip(_col(c).cast("string"))
    return F.when(text.isNull() | text.isin("", "nan", "None"), F.lit(label)).otherwise(text)


def or_unknown(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(domain.UNKNOWN_MARK))


def destination_label(city: Column | str, country: Column | str) -> Column:
    return F.concat(or_unknown(city), F.lit(" ("), or_unknown(country), F.lit(")"))


def route_label(start: Column | str, end: Column | str) -> Column:
    return F.concat(or_unknown(start), F.lit(" → "), or_unknown(end))


def clean_name(name: str, fold: bool = False) -> str:
    """Header text trimmed; with ``fold`` also upper-cased and without È."""
    name = str(name).strip()
    return name.upper().replace("È", "E") if fold else name
