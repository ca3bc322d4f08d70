"""Date parts and date formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions.columns import col, is_datetime_type, require, type_of
from limpid.functions.dates import java_date_pattern


def _datetime(df: DataFrame, column: str) -> str:
    (name,) = require(df, column)
    if not is_datetime_type(type_of(df, name)):
        raise TypeError(f"column {name!r} is not a date; convert it with to_datetime first")
    return name


def extract_date_parts(df: DataFrame, column: str) -> DataFrame:
    """Add ``_Year``, ``_Month``, ``_Day`` and ``_Weekday`` (Monday is 0)."""
    d = col(_datetime(df, column))
    return df.withColumns({
        f"{column}_Year": F.year(d), f"{column}_Month": F.month(d),
        f"{column}_Day": F.dayofmonth(d), f"{column}_Weekday": F.weekday(d)})


def format_dates(df: DataFrame, column: str, fmt: str = "%Y-%m-%d") -> DataFrame:
    """Dates as text in a strftime format."""
    return df.withColumn(column, F.date_format(col(_datetime(df, column)), java_date_pattern(fmt)))
