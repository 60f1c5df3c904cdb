"""Deterministic pseudo-geocoding and great-circle distance."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.defaults import DEFAULT_POSTCODE, EARTH_RADIUS_KM, OFFICE
from perkline.functions.text import hex_to_long

# Origin of the pseudo-coordinates in ten-thousandths of a degree.
LAT_ORIGIN = 434_000
LON_ORIGIN = 37_000


def office_coordinates(office: tuple[Decimal, Decimal] = OFFICE) -> tuple[Column, Column]:
    return tuple(F.lit(v).cast("decimal(10,6)") for v in office)


def _degrees(ten_thousandths: Column) -> Column:
    return (ten_thousandths.cast("decimal(16,6)") / F.lit(Decimal("10000"))).cast("decimal(10,6)")


def geocode(
    address: Column, method: str = "md5", office: tuple[Decimal, Decimal] = OFFICE
) -> tuple[Column, Column]:
    """(latitude, longitude) derived from the postcode and a digest of the address.

    ``md5`` takes the first five digits found anywhere and hashes a NULL address as empty text;
    ``sha256`` wants a free-standing postcode and puts an empty address at the office.
    All arithmetic is integer, so the coordinates are exact.
    """
    if method == "md5":
        digits, digest = "([0-9]{5})", F.md5(F.coalesce(address, F.lit("")))
    elif method == "sha256":
        digits, digest = r"(?U)\b([0-9]{5})\b", F.sha2(address, 256)
    else:
        raise ValueError(f"unknown geocoding method: {method}")
    found = F.nullif(F.regexp_extract(address, digits, 1), F.lit("")).cast("int")
    postcode = F.coalesce(found, F.lit(DEFAULT_POSTCODE))
    lat = F.lit(LAT_ORIGIN) + (postcode % 300) * 10 + hex_to_long(digest, 1) % 1000
    lon = F.lit(LON_ORIGIN) + (F.floor(postcode / 10) % 300) * 10 + hex_to_long(digest, 9) % 1000
    lat, lon = _degrees(lat), _degrees(lon)
    if method == "sha256":
        missing = F.coalesce(address, F.lit("")) == ""
        office_lat, office_lon = office_coordinates(office)
        lat, lon = F.when(missing, office_lat).otherwise(lat), F.when(missing, office_lon).otherwise(lon)
    return lat, lon


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, form: str = "atan2") -> Column:
    """Great-circle distance in km, two decimals. ``form`` picks the closing formula."""
    lat1, lon1, lat2, lon2 = (c.cast("double") for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    chord = F.least(F.lit(1.0), chord)  # rounding can push it above 1; NULL is kept below
    if form == "atan2":
        angle = F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))
    elif form == "asin":
        angle = F.asin(F.sqrt(chord))
    else:
        raise ValueError(f"unknown haversine form: {form}")
    km = F.round(F.lit(2.0 * EARTH_RADIUS_KM) * angle, 2).cast("decimal(10,2)")
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, km)
