"""Expressions that bring one record field into its canonical form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from limpid.functions.text import strip

# Fixed value: what counts as a valid address after trimming and lower-casing.
EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"


def literal_map(mapping: Mapping) -> Column:
    """A map literal for a lookup of modest size."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.create_map(*pairs)


def lookup(value: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; a value that is not a key gives NULL."""
    return literal_map(mapping)[value] if mapping else F.lit(None).cast("string")


def category(value: Column, mapping: Mapping[str, str], unknown: str | None = "Unknown") -> Column:
    """Trim, lower-case and look up the canonical label; the rest becomes ``unknown``."""
    label = lookup(F.lower(strip(value)), mapping)
    return F.coalesce(label, F.lit(unknown)) if unknown is not None else label


def keep_if(value: Column, valid: Column) -> Column:
    """The value where it is valid, else missing."""
    return F.when(valid, value)


def email(value: Column, pattern: str = EMAIL_PATTERN) -> Column:
    address = F.lower(strip(value))
    return keep_if(address, address.rlike(pattern))


def phone(value: Column, *, country: str = "91", trunk: str = "0", length: int = 10) -> Column:
    """``+CC-`` and the national number, or missing when the digits do not add up."""
    digits = F.regexp_replace(value, r"[^0-9]", "")
    size = F.length(digits)
    with_country = (size == length + len(country)) & digits.startswith(country)
    with_trunk = (size == length + len(trunk)) & digits.startswith(trunk)
    national = (
        F.when(with_country, digits.substr(len(country) + 1, length))
        .when(with_trunk, digits.substr(len(trunk) + 1, length))
        .when(size == length, digits))
    return F.concat(F.lit(f"+{country}-"), national)
