"""Group-by, pivot and frequency tables; missing keys are left out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    as_number, col, is_missing, is_numeric_type, present, require, type_of,
)
from limpid.plans.fitting import fitted
from limpid.plans.grouped_quantiles import grouped_median
from limpid.plans.sizing import is_small

FUNCTIONS = ("mean", "sum", "count", "min", "max", "std", "median")


def _expression(value: Column, func: str) -> Column:
    """The aggregate; an empty sum is zero, the deviation is the sample one."""
    return {
        "mean": lambda: F.avg(value.cast("double")),
        "sum": lambda: F.coalesce(F.sum(value), F.lit(0)),
        "count": lambda: F.count(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "std": lambda: F.stddev_samp(value.cast("double")),
        "median": lambda: F.median(value.cast("double")),
    }[func]()


def _as_target(df: DataFrame, name: str, func: str, coerce: bool) -> Column:
    """What gets aggregated: a number when coercing or computing, else the column as it is."""
    data_type = type_of(df, name)
    if isinstance(data_type, T.IntegralType):
        return col(name).cast("long")
    if coerce or is_numeric_type(data_type):
        return as_number(df, name)
    if func not in ("count", "min", "max"):
        raise TypeError(f"column {name!r} is {data_type.simpleString()}, {func} needs a number")
    return col(name)


def _grouped(
    df: DataFrame, keys: list[str], target: str, func: str, name: str, *, coerce: bool, distributed_median: bool = False
) -> DataFrame:
    """Keys and one aggregate, over rows whose keys are all there."""
    if func not in FUNCTIONS:
        raise ValueError(f"func must be one of {FUNCTIONS}")
    value = f"__{target}"
    keyed = reduce(lambda d, k: d.where(~is_missing(df, k)), keys, df)
    slim = keyed.select(*[col(k) for k in keys], _as_target(df, target, func, coerce).alias(value))
    if func == "median" and (distributed_median or not is_small(slim)):
        return grouped_median(slim, keys, value, name)
    return slim.groupBy(*[col(k) for k in keys]).agg(_expression(col(value), func).alias(name))


def groupby_aggregate(
    df: DataFrame, by: str | Sequence[str], target: str, func: str = "mean", *,
    sort: bool = False, distributed_median: bool = False,
) -> DataFrame:
    """``by`` columns and ``{target}_{func}``; the target is read as a number first.

    ``distributed_median`` forces the median that needs no per-group memory,
    which large inputs use anyway.
    """
    keys = require(df, by)
    require(df, target)
    out = _grouped(df, keys, target, func, f"{target}_{func}", coerce=True,
                   distributed_median=distributed_median)
    return out.orderBy(*[col(k) for k in keys]) if sort else out


def pivot(
    df: DataFrame, index: str | Sequence[str], columns: str, values: str, aggfunc: str = "mean", *,
    labels: Sequence | None = None, max_values: int = 1000, sort: bool = False,
) -> DataFrame:
    """Cross table: one row per index, one column per label of ``columns``.

    ``labels`` saves the job that finds them; without it at most ``max_values``
    labels are accepted.  Cells without rows are missing, and index rows whose
    cells are all missing are left out.  The aggregation runs per (index, label)
    before the cells are laid out, so a hot index value is spread over its labels.
    """
    keys = require(df, index)
    require(df, columns)
    require(df, values)
    if labels is None:
        found = _labels(df, columns, values if aggfunc not in ("count", "sum") else None, max_values)
        texts = {text: str(label) for label, text in found}
    else:
        kind = df.schema[columns].dataType
        spelled = df.sparkSession.range(1).select(
            *[F.lit(x).cast(kind).cast("string").alias(f"l{n}") for n, x in enumerate(labels)]).first()
        texts = {text: str(x) for text, x in zip(spelled, labels)}
    cells = _grouped(df, [*keys, columns], values, aggfunc, "__cell", coerce=False)
    wide = _lay_out(cells.where(F.col("__cell").isNotNull()), keys, columns, texts)
    return wide.orderBy(*[col(k) for k in keys]) if sort else wide


@fitted
def _labels(df: DataFrame, columns: str, needs: str | None, max_values: int) -> list:
    """The sorted labels of the rows that can give a cell, each with Spark's text for it."""
    rows = df.where(~is_missing(df, columns))
    if needs:
        rows = rows.where(~is_missing(df, needs))
    label = present(df, columns)
    found = rows.select(label.alias("label"), label.cast("string").alias("text")).distinct().limit(max_values + 1).collect()
    if len(found) > max_values:
        raise ValueError(f"column {columns!r} has more than {max_values} labels; pass labels or raise max_values")
    return sorted((r["label"], r["text"]) for r in found)


def _lay_out(cells: DataFrame, keys: list[str], columns: str, texts: dict[str, str]) -> DataFrame:
    label = col(columns).cast("string").alias("__label")
    long = cells.select(*[col(k) for k in keys], label, "__cell")
    wide = long.groupBy(*[col(k) for k in keys]).pivot("__label", list(texts)).agg(F.first("__cell"))
    return wide.select(*[col(k) for k in keys], *[col(t).alias(name) for t, name in texts.items()])


def unique_value_counts(df: DataFrame, column: str, *, sort: bool = False) -> DataFrame:
    """``(column, count)`` of the values that are there."""
    require(df, column)
    value = present(df, column).alias(column)
    out = df.select(value).where(col(column).isNotNull()).groupBy(col(column)).agg(F.count("*").alias("count"))
    return out.orderBy(col(column)) if sort else out
