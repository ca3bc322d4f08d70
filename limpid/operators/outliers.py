"""Outliers by quartile fences and by z-score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.columns import as_number, col, require_numeric, resolve
from limpid.plans.fitting import fitted
from limpid.plans.quantiles import exact_quantiles
from limpid.plans.sizing import cut_lineage, is_small

Columns = str | Sequence[str]


def clipped(value: Column, low: float | None, high: float | None) -> Column:
    """Pull values into [low, high]; missing stays missing."""
    out = value
    if high is not None:
        out = F.when(value > F.lit(high), F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(value < F.lit(low), F.lit(low)).otherwise(out)
    return out


@dataclass(frozen=True)
class Fences:
    """Lower and upper fence per column, fitted once and reusable on other tables."""

    bounds: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Columns, factor: float = 1.5, **options) -> Fences:
        names = resolve(df, columns, numeric=True)
        quartiles = exact_quantiles(df, {n: as_number(df, n) for n in names}, [0.25, 0.75], **options)
        bounds = {}
        for n, (q1, q3) in quartiles.items():
            if q1 is not None:
                bounds[n] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        return cls(bounds)

    def outside(self, df: DataFrame, name: str) -> Column:
        low, high = self.bounds[name]
        value = as_number(df, name)
        return F.coalesce((value < low) | (value > high), F.lit(False))

    def cap(self, df: DataFrame) -> DataFrame:
        out = {n: clipped(as_number(df, n), low, high) for n, (low, high) in self.bounds.items()}
        return df.withColumns(out) if out else df

    def keep_inside(self, df: DataFrame) -> DataFrame:
        """Rows whose every fenced value is inside or missing."""
        for n in self.bounds:
            df = df.where(~self.outside(df, n))
        return df


def detect_outliers_iqr(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """One row: ``column, count, lower, upper``."""
    require_numeric(df, column)
    fences = Fences.fit(df, column, factor)
    if column not in fences.bounds:
        nothing = F.lit(None).cast("double")
        return df.agg(F.lit(column).alias("column"), F.count_if(F.lit(False)).alias("count"),
                      nothing.alias("lower"), nothing.alias("upper"))
    low, high = fences.bounds[column]
    return df.agg(
        F.lit(column).alias("column"), F.count_if(fences.outside(df, column)).alias("count"),
        F.lit(low).alias("lower"), F.lit(high).alias("upper"))


def cap_outliers_iqr(df: DataFrame, columns: Columns, factor: float = 1.5) -> DataFrame:
    """Pull outliers to the nearer fence.  Columns are independent, so one fit serves all."""
    return Fences.fit(df, columns, factor).cap(df)


def remove_outliers_iqr(df: DataFrame, columns: Columns, factor: float = 1.5) -> DataFrame:
    """Drop rows outside the fences; each column's fences come from the rows left by the ones before.

    The fits run on the named columns alone; of large inputs these are written once, so that what lies above
    isn't repeated for every column.
    """
    names = resolve(df, columns, numeric=True)
    slim = df.select(*[col(n) for n in names])
    if len(names) > 1 and not is_small(df):
        slim = cut_lineage(slim)
    for n in names:
        fences = Fences.fit(slim, n, factor)
        slim, df = fences.keep_inside(slim), fences.keep_inside(df)
    return df


@dataclass(frozen=True)
class ZScore:
    """Mean and population deviation of one column."""

    column: str
    mean: float | None
    std: float | None

    @classmethod
    @fitted
    def fit(cls, df: DataFrame, column: str) -> ZScore:
        value = as_number(df, column)
        row = df.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s")).first()
        return cls(column, row["m"], row["s"])

    def outside(self, df: DataFrame, threshold: float) -> Column:
        if not self.std:
            return F.lit(False)
        z = (as_number(df, self.column) - F.lit(self.mean)) / F.lit(self.std)
        return F.coalesce(F.abs(z) > threshold, F.lit(False))


def detect_outliers_zscore(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """One row: ``column, count`` of values more than ``threshold`` deviations from the mean."""
    require_numeric(df, column)
    z = ZScore.fit(df, column)
    return df.agg(F.lit(column).alias("column"), F.count_if(z.outside(df, threshold)).alias("count"))
