"""Dates from mixed text and text from dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = r"^\d{4}(-\d{1,2}(-\d{1,2}([T ]\d{1,2}:.*)?)?)?$"
#: A date (group 1) with a time of day after it: hour, the rest of the time, a or p.
TIMED_SHAPE = r"(?i)^(.+?)[T, ]\s*(\d{1,2})(:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)\s*(?:([ap])\.?m\.?)?$"
YEAR_FIRST_SHAPE = r"^(\d{4})([/.-])(\d{1,2})\2(\d{1,2})$"
COMPACT_SHAPE = r"^(\d{4})(\d{2})(\d{2})$"
YEAR_LAST_SHAPE = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})$"
#: Two digits first and one digit last: only the first can be the year.
SHORT_YEAR_FIRST_SHAPE = r"^\d{2}-\d{1,2}-\d$"
MONTH_DAY_SHAPE = r"^([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4}|\d{2})$"
DAY_MONTH_SHAPE = r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4}|\d{2})$"
#: Two-digit years from here on belong to the 1900s, those below to the 2000s.
LAST_CENTURY = "69"
MONTHS = ("january february march april may june july august september october november december").split()

# Strftime codes and the pattern letters that print the same.
STRFTIME = {
    "Y": "yyyy", "y": "yy", "m": "MM", "B": "MMMM", "b": "MMM", "d": "dd", "j": "DDD",
    "A": "EEEE", "a": "EEE", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "p": "a",
}


def _without_time(clean: Column) -> Column:
    return F.trim(F.regexp_replace(clean, TIMED_SHAPE, "$1"))


def _full_year(year: Column) -> Column:
    """Two digits as a year of four."""
    return F.when(F.length(year) == 4, year).when(year >= LAST_CENTURY, F.concat(F.lit("19"), year)).otherwise(
        F.concat(F.lit("20"), year))


def _as_day(year: Column, month: Column, day: Column) -> Column:
    """A date from texts of digits; NULL if there is no such day."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def _month_number(name: Column) -> Column:
    """The number of a month name, whole or cut to three letters (or ``sept``); else NULL."""
    numbers = {n: i for i, m in enumerate(MONTHS, 1) for n in (m, m[:3])} | {"sept": 9}
    pairs = [F.lit(x) for month, number in numbers.items() for x in (month, str(number))]
    return F.try_element_at(F.create_map(*pairs), F.lower(name))


def parse_datetime(text: Column, *, dayfirst: bool = False) -> Column:
    """Text to a timestamp without zone; the format is decided per value, garbage is NULL.

    ISO text, with or without a time of day and down to a bare year, is cast.  Dates may be split by dashes, slashes
    or dots, or be eight digits, or name the month; all may have a time of 24 or 12 hours after them.  Two-digit
    years lie between 1969 and 2068.  Numeric dates with the year last are month first (day first on request) and
    fall back to the other reading when the month would be above 12.
    """
    clean = F.trim(text)
    # a time of day has a colon: without one the value is the date itself, and nothing else is looked for
    timed = F.when(clean.rlike(TIMED_SHAPE), F.concat(
        F.get(F.transform(F.array(_without_time(clean)), lambda date: _day(date, dayfirst)), F.lit(0)).cast("string"),
        F.lit(" "), _time_of(clean)).try_cast("timestamp_ntz"))
    iso = F.when(clean.rlike(ISO_SHAPE), clean.try_cast("timestamp_ntz"))
    return F.when(F.contains(clean, F.lit(":")), F.coalesce(iso, timed)).otherwise(
        F.coalesce(iso, _day(clean, dayfirst).cast("timestamp_ntz")))


def _time_of(clean: Column) -> Column:
    """The time of day behind a date, in 24 hours; NULL if the hour isn't one."""
    hour, rest, half = (F.regexp_extract(clean, TIMED_SHAPE, g) for g in (2, 3, 4))
    number = hour.try_cast("int")
    hour = F.when(half == "", number).when(
        number.between(1, 12), number % 12 + F.when(F.lower(half) == "p", 12).otherwise(0))
    return F.concat(hour.cast("string"), rest)


def _day(date: Column, dayfirst: bool) -> Column:
    """The date that a text without a time spells.  Its shape is found first; only that shape's reading is worked out."""
    numbers = F.translate(date, "/.", "--")
    one, two, three = (F.split_part(numbers, F.lit("-"), F.lit(n)) for n in (1, 2, 3))
    readings = [_as_day(_full_year(three), *order) for order in ((one, two), (two, one))]
    # March 5, 2024 becomes March-5-2024 and 5 Mar. 2024 becomes 5-Mar-2024
    words = F.translate(date, " .,", "-")
    first, second, year = (F.split_part(words, F.lit("-"), F.lit(n)) for n in (1, 2, 3))
    return (F.when(date.rlike(YEAR_LAST_SHAPE), F.coalesce(*(reversed(readings) if dayfirst else readings)))
            .when(date.rlike(YEAR_FIRST_SHAPE), numbers.try_cast("date"))
            .when(date.rlike(COMPACT_SHAPE), _as_day(*(F.substring(date, *at) for at in ((1, 4), (5, 2), (7, 2)))))
            .when(date.rlike(SHORT_YEAR_FIRST_SHAPE), _as_day(_full_year(one), two, three))
            .when(date.rlike(MONTH_DAY_SHAPE), _as_day(_full_year(year), _month_number(first), second))
            .when(date.rlike(DAY_MONTH_SHAPE), _as_day(_full_year(year), _month_number(second), first)))


def is_ambiguous_date(text: Column) -> Column:
    """Whether month-first and day-first reading both work and give different days."""
    date = _without_time(F.trim(text))
    first, second = (
        F.nullif(F.regexp_extract(date, YEAR_LAST_SHAPE, i), F.lit("")).cast("int") for i in (1, 3))
    return F.coalesce(first.between(1, 12) & second.between(1, 12) & (first != second), F.lit(False))


def java_date_pattern(fmt: str) -> str:
    """Translate a strftime format; a code without an equivalent is an error."""
    out, literal, i = [], [], 0

    def flush() -> None:
        if literal:
            text = "".join(literal).replace("'", "''")
            out.append(f"'{text}'" if any(ch.isalpha() for ch in text) or "'" in text else text)
            literal.clear()

    while i < len(fmt):
        if fmt[i] != "%":
            literal.append(fmt[i])
            i += 1
            continue
        code = fmt[i + 1:i + 2]
        if code == "%":
            literal.append("%")
        elif code in STRFTIME:
            flush()
            out.append(STRFTIME[code])
        else:
            raise ValueError(f"date code %{code} is not supported; known: {sorted(STRFTIME)}")
        i += 2
    flush()
    return "".join(out)
