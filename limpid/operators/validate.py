"""Validation counts, clipping and invalidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import as_number, col, present, require, require_numeric, resolve, type_of
from limpid.functions.text import matches_from_start
from limpid.operators.outliers import clipped


def validate_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: ``column, invalid`` values that do not match from the start; missing counts."""
    require(df, column)
    return df.agg(F.lit(column).alias("column"),
                  F.count_if(~matches_from_start(col(column), pattern)).alias("invalid"))


def validate_range(df: DataFrame, column: str, min_value: float, max_value: float) -> DataFrame:
    """One row: ``column, invalid`` values outside the closed range; missing does not count."""
    value = as_number(df, require_numeric(df, column))
    outside = F.coalesce((value < min_value) | (value > max_value), F.lit(False))
    return df.agg(F.lit(column).alias("column"), F.count_if(outside).alias("invalid"))


def clip_to_range(df: DataFrame, column, min_value=None, max_value=None) -> DataFrame:
    """Force numeric columns into the range; the type stays when the bounds fit it."""
    out = {}
    for n in resolve(df, column, numeric=True):
        data_type = type_of(df, n)
        bounds = [b for b in (min_value, max_value) if b is not None]
        whole = isinstance(data_type, T.IntegralType) and all(float(b).is_integer() for b in bounds)
        if whole:
            low, high = (None if b is None else int(b) for b in (min_value, max_value))
            out[n] = clipped(col(n), low, high).cast(data_type)
        else:
            out[n] = clipped(present(df, n).cast("double"), min_value, max_value)
    return df.withColumns(out) if out else df


def invalidate(df: DataFrame, column: str, valid: Column) -> DataFrame:
    """Turn values that fail a condition into missing."""
    require(df, column)
    return df.withColumn(column, F.when(valid, col(column)))
