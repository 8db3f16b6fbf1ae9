"""Readers of drop files, reference tables and the warehouse."""

from sootledger.sources.drops import (
    read_equipment_drops,
    read_personnel_drops,
    read_trip_drops,
    read_trip_places,
)
from sootledger.sources.references import (
    band_factors,
    read_coordinates,
    read_distances,
    read_factor_table,
    read_impacts,
    split_impacts,
)
from sootledger.sources.warehouse import (
    Star,
    as_of,
    days_available,
    load_metadata,
    load_star,
    load_star_any,
    read_csv_table,
    rebuild_from_days,
    register_views,
    versions_available,
)

__all__ = [
    "Star", "as_of", "band_factors", "days_available", "load_metadata", "load_star",
    "load_star_any", "read_coordinates", "read_csv_table", "read_distances",
    "read_equipment_drops", "read_factor_table", "read_impacts", "read_personnel_drops",
    "read_trip_drops", "read_trip_places", "rebuild_from_days", "register_views",
    "split_impacts", "versions_available",
]
