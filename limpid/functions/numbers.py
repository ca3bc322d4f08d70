"""Numbers from text, and rounding as the statistics world does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What reads as a number.  Checking the shape first also keeps text columns from
# raising and catching one exception per cell inside the cast.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


WHOLE = r"^\s*[+-]?\d+\s*$"


def parse_long(text: Column) -> Column:
    """Text to long; anything that is not a whole number in range is NULL."""
    return F.when(text.rlike(WHOLE), text.try_cast("long"))


def parse_double(text: Column) -> Column:
    """Text to double; surrounding blanks and exponents are fine, anything else is NULL."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def parse_amount(text: Column, marks: str = ",") -> Column:
    """Text amount to double after removing thousands marks or currency signs."""
    return parse_double(F.translate(text, marks, ""))


def half_even_long(number: Column) -> Column:
    """Round half to even and make it a whole number."""
    return F.bround(number, 0).cast("long")
