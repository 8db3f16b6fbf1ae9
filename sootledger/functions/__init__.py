"""Column functions: text, dates, numbers and distances, all JVM-side but the geodesic."""

from sootledger.functions.dates import (
    add_days,
    day_calendar,
    day_label,
    day_of_file,
    file_name_of,
    to_day,
    year_month,
    years_between,
)
from sootledger.functions.geo import geodesic_km, haversine_km
from sootledger.functions.numbers import (
    half_even,
    thousands,
    to_number,
    to_tonnes,
    tonnes_or_zero,
)
from sootledger.functions.text import (
    blank_to_null,
    clean_name,
    contains_text,
    destination_label,
    has_text,
    is_default_model,
    label_missing,
    na_to_null,
    return_multiplier,
    route_label,
    segment,
    site_of,
    strip,
    transport_code,
    translate_values,
)

__all__ = [
    "add_days", "blank_to_null", "clean_name", "contains_text", "day_calendar", "day_label",
    "day_of_file", "destination_label", "file_name_of", "geodesic_km", "half_even", "has_text", "haversine_km", "is_default_model",
    "label_missing", "na_to_null", "return_multiplier", "route_label", "segment", "site_of",
    "strip", "thousands", "to_day", "to_number", "to_tonnes", "tonnes_or_zero",
    "translate_values", "transport_code", "year_month", "years_between",
]
