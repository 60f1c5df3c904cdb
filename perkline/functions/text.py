"""Text, key and hash expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.defaults import ACCENTED, COHORTS, MODE_LOOKUP, PLAIN, UNKNOWN_MODE


def clean_numeric_key(key: Column) -> Column:
    """Identifier as text without a trailing ``.0`` left behind by a numeric column."""
    return F.regexp_replace(key.cast("string"), r"\.0$", "")


def row_hash(columns: Iterable[Column]) -> Column:
    """SHA-256 of the ``|``-joined values, NULL hashed as empty text."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def stable_id(key: Column, suffix: str) -> Column:
    """MD5 id of a key within one feed; a NULL key gives a NULL id."""
    return F.md5(F.concat(key, F.lit(f"-{suffix}")))


def nullif_trim(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Both names joined by a space; missing parts are skipped."""
    return F.concat_ws(" ", first, last)


def strict_cast(text: Column, data_type: str, strict: bool = True) -> Column:
    """Cast text whose empty value means NULL.

    Strict raises on bad text (ANSI cast); lenient turns it into NULL so that the caller can
    route the row to a reject table.
    """
    value = F.nullif(text, F.lit(""))
    return value.cast(data_type) if strict else value.try_cast(data_type)


def normalize_text_mode(mode: Column) -> Column:
    """Fold lowercase accents, then lowercase. Uppercase accents survive the folding."""
    return F.lower(F.translate(F.coalesce(mode, F.lit(UNKNOWN_MODE)), ACCENTED, PLAIN))


def normalize_mode_lookup(mode: Column, lookup: dict[str, str] = MODE_LOOKUP) -> Column:
    """Lowercase and trim, then replace whole labels found in ``lookup``."""
    label = F.lower(F.trim(mode))
    table = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    replaced = F.coalesce(F.try_element_at(table, label), label)
    return F.when(F.coalesce(mode, F.lit("")) == "", F.lit(UNKNOWN_MODE)).otherwise(replaced)


def city_from_address(address: Column) -> Column:
    """Second comma-separated part without its leading postcode; empty when there is none."""
    part = F.trim(F.split_part(address, F.lit(","), F.lit(2)))
    return F.regexp_replace(part, r"^[0-9]{5}\s+", "")


def render(parts: Sequence[str | Column]) -> Column:
    """Concatenate literals and columns; NULL columns render as nothing."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def hex_to_long(digest: Column, start: int, length: int = 8) -> Column:
    """Unsigned integer value of a slice of a hexadecimal digest."""
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def cohort(key: Column, weights: Sequence[tuple[str, float]] = COHORTS) -> Column:
    """Stable weighted cohort of a key, from the first 32 bits of its MD5."""
    marker = (hex_to_long(F.md5(key), 1) % 10_000) / F.lit(10_000.0)
    total = sum(weight for _, weight in weights)
    cumulative, choice = 0.0, None
    for name, weight in weights:
        cumulative += weight / total
        hit = marker <= F.lit(cumulative)
        choice = F.when(hit, name) if choice is None else choice.when(hit, name)
    return F.when(key.isNotNull(), choice.otherwise(weights[-1][0]))
