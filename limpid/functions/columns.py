"""Column selection and the one definition of "missing" used everywhere.

A cell is missing when it is NULL or, in a floating column, NaN.  Operators
never need NaN to be scrubbed first: they go through :func:`is_missing` and
:func:`present`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.numbers import parse_double


class UnknownColumnError(ValueError):
    """A column was named that the table does not have."""


def col(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def is_text_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))


def is_datetime_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def require(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """The given names as a list; unknown ones raise."""
    wanted = [names] if isinstance(names, str) else list(names)
    unknown = [n for n in wanted if n not in df.columns]
    if unknown:
        raise UnknownColumnError(f"unknown column(s) {unknown}; the table has {df.columns}")
    return wanted


def resolve(
    df: DataFrame,
    columns: str | Iterable[str] | None = None,
    *,
    numeric: bool = False,
    text: bool = False,
    strict: bool = False,
) -> list[str]:
    """Turn a column selection into existing names.

    ``None`` selects all columns and an empty list none.  Unknown names are
    dropped unless ``strict``.  ``numeric`` / ``text`` keep one type family.
    """
    if columns is None:
        names = list(df.columns)
    elif strict:
        names = require(df, columns)
    else:
        asked = [columns] if isinstance(columns, str) else list(columns)
        names = [n for n in asked if n in df.columns]
    if numeric:
        names = [n for n in names if is_numeric_type(type_of(df, n))]
    if text:
        names = [n for n in names if is_text_type(type_of(df, n))]
    return names


def require_numeric(df: DataFrame, name: str) -> str:
    (name,) = require(df, name)
    if not is_numeric_type(type_of(df, name)):
        raise TypeError(f"column {name!r} is {type_of(df, name).simpleString()}, a number is needed")
    return name


def _floating(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), (T.DoubleType, T.FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    c = col(name)
    return (c.isNull() | F.isnan(c)) if _floating(df, name) else c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value, with NaN turned into NULL."""
    c = col(name)
    return F.when(~F.isnan(c), c) if _floating(df, name) else c


#: Longer texts are compared by digest: 65 characters travel instead of the whole text.
SHORT_TEXT = 64


def fingerprint(df: DataFrame, name: str) -> Column:
    """A value that is equal exactly when the cells are, and short even for long texts.

    A digest is one character longer than any text kept as it is, so the two
    cannot be mistaken for each other.
    """
    value = present(df, name)
    if not is_text_type(type_of(df, name)):
        return value
    digest = F.concat(F.lit("#"), F.sha2(value, 256))
    return F.when(F.length(value) > SHORT_TEXT, digest).otherwise(value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (for tables leaving the library)."""
    floating = [n for n in df.columns if _floating(df, n)]
    return df.withColumns({n: present(df, n) for n in floating}) if floating else df


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double: numbers widen, text is parsed, anything else is missing."""
    data_type = type_of(df, name)
    if is_text_type(data_type):
        return parse_double(col(name))
    if is_numeric_type(data_type) or isinstance(data_type, T.BooleanType):
        return present(df, name).cast("double")
    return F.lit(None).cast("double")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A helper column name the table does not use yet."""
    name = f"__{stem}"
    while name in df.columns:
        name += "_"
    return name
