"""Column expressions: plain functions ``Column -> Column``, no UDFs."""

from perkline.functions.dates import duration_seconds, excel_serial_to_date, reference_year
from perkline.functions.geo import geocode, haversine_km
from perkline.functions.text import (
    city_from_address,
    clean_numeric_key,
    cohort,
    full_name,
    normalize_mode_lookup,
    normalize_text_mode,
    nullif_trim,
    render,
    row_hash,
    stable_id,
    strict_cast,
)
from perkline.functions.activity import activity_message, is_valid_activity

__all__ = [
    "activity_message", "city_from_address", "clean_numeric_key", "cohort", "duration_seconds",
    "excel_serial_to_date", "full_name", "geocode", "haversine_km", "is_valid_activity",
    "normalize_mode_lookup", "normalize_text_mode", "nullif_trim", "reference_year", "render",
    "row_hash", "stable_id", "strict_cast",
]
