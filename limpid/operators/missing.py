"""Missing values: drop, fill, carry, interpolate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    as_number, col, fresh_name, is_missing, is_numeric_type, present, require, resolve, type_of,
)
from limpid.plans.fitting import fitted
from limpid.plans.frequencies import most_frequent
from limpid.plans.ordering import Ordered, Segmented, order_value, running
from limpid.plans.quantiles import exact_quantiles

Columns = str | Sequence[str] | None


def drop_missing(
    df: DataFrame,
    axis: int = 0,
    how: str = "any",
    thresh: int | None = None,
    subset: Columns = None,
) -> DataFrame:
    """Drop rows (``axis=0``) or columns (``axis=1``) with missing values.

    ``how="any"`` drops on one gap, ``"all"`` only when nothing is there;
    ``thresh`` keeps whatever has at least that many values and overrides ``how``.
    """
    if how not in ("any", "all"):
        raise ValueError("how must be 'any' or 'all'")
    if axis == 1:
        return DropColumns.fit(df, how=how, thresh=thresh).apply(df)
    names = require(df, subset) if subset is not None else df.columns
    if not names:
        return df
    if thresh is not None:
        filled = reduce(lambda a, b: a + b, [(~is_missing(df, n)).cast("int") for n in names])
        return df.where(filled >= thresh)
    here = [~is_missing(df, n) for n in names]
    keep = reduce((lambda a, b: a & b) if how == "any" else (lambda a, b: a | b), here)
    return df.where(keep)


@dataclass(frozen=True)
class DropColumns:
    """Columns found too empty to keep."""

    columns: tuple[str, ...]

    @classmethod
    @fitted
    def fit(cls, df: DataFrame, how: str = "any", thresh: int | None = None) -> DropColumns:
        counts = df.agg(
            F.count("*").alias("__rows"),
            *[F.count(F.when(~is_missing(df, n), 1)).alias(f"c{i}") for i, n in enumerate(df.columns)]).first()
        rows = counts["__rows"]
        least = thresh if thresh is not None else (rows if how == "any" else min(1, rows))
        return cls(tuple(n for i, n in enumerate(df.columns) if counts[f"c{i}"] < least))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.select(*[col(n) for n in df.columns if n not in self.columns])


def _typed_literal(df: DataFrame, name: str, value: object) -> Column:
    """The value in the column's type; a value that does not fit raises here, not in a task."""
    data_type = type_of(df, name)
    if isinstance(value, Column):
        return value.cast(data_type)
    if is_numeric_type(data_type):
        number = float(value) if not isinstance(value, bool) else float(bool(value))
        if isinstance(data_type, T.IntegralType) and number != int(number):
            return F.lit(number)
        return F.lit(value if isinstance(value, (int, float)) else (
            int(number) if isinstance(data_type, T.IntegralType) else number)).cast(data_type)
    if isinstance(data_type, T.StringType):
        return F.lit(str(value))
    if isinstance(data_type, T.BooleanType):
        text = str(value).strip().lower()
        if text not in ("true", "false", "1", "0"):
            raise ValueError(f"{value!r} is not a boolean, as column {name!r} needs")
        return F.lit(text in ("true", "1"))
    return F.lit(str(value)).cast(data_type)


def fill_missing_constant(df: DataFrame, value: object, columns: Columns = None) -> DataFrame:
    """Fill every gap with one value, cast to each column's type."""
    names = resolve(df, columns)
    return FillValues({n: value for n in names}).apply(df)


@dataclass(frozen=True)
class FillValues:
    """One fill value per column; ``apply`` is a narrow projection."""

    values: dict[str, object]
    #: Columns that turn into doubles because their fill value is a mean or median.
    widened: frozenset[str] = frozenset()
    notes: tuple[str, ...] = field(default=())

    @classmethod
    def fit(cls, df: DataFrame, strategy: str = "mean", columns: Columns = None, **options) -> FillValues:
        if strategy in ("mean", "median"):
            names = resolve(df, columns, numeric=True)
            if strategy == "mean":
                found = _means(df, names)
            else:
                quantiles = exact_quantiles(df, {n: as_number(df, n) for n in names}, [0.5], **options)
                found = {n: q[0] for n, q in quantiles.items()}
        elif strategy == "mode":
            names = resolve(df, columns)
            found = {n: v for n, (v, _) in most_frequent(df, names).items()}
        else:
            raise ValueError("strategy must be 'mean', 'median' or 'mode'")
        empty = [n for n in names if found.get(n) is None]
        return cls(
            {n: found[n] for n in names if n not in empty},
            frozenset() if strategy == "mode" else frozenset(names),
            tuple(f"{n}: no value to fill from" for n in empty))

    def apply(self, df: DataFrame) -> DataFrame:
        out = {}
        for n, value in self.values.items():
            here = present(df, n)
            if n in self.widened:
                out[n] = F.coalesce(here.cast("double"), F.lit(float(value)))
            else:
                out[n] = F.coalesce(here, _typed_literal(df, n, value))
        for n in self.widened - set(self.values):
            out[n] = present(df, n).cast("double")
        return df.withColumns(out) if out else df


@fitted
def _means(df: DataFrame, names: Sequence[str]) -> dict[str, float | None]:
    if not names:
        return {}
    row = df.agg(*[F.avg(as_number(df, n)).alias(f"m{i}") for i, n in enumerate(names)]).first()
    return {n: row[f"m{i}"] for i, n in enumerate(names)}


def fill_missing_statistic(df: DataFrame, strategy: str = "mean", columns: Columns = None) -> DataFrame:
    """Fill gaps with the column's mean, exact median or mode (ties: the smallest value)."""
    return FillValues.fit(df, strategy, columns).apply(df)


def fill_missing_ffill(df: DataFrame, columns: Columns = None, *, order_by: Columns = None,
                       partition_by: Columns = None, buckets: int | None = None) -> DataFrame:
    """Copy the last known value forward in ``order_by`` order; leading gaps stay.

    With ``partition_by`` nothing is carried from one series to another; rows whose series is missing are one
    series, and the columns that name the series are not filled.
    """
    return _carried(df, _fillable(df, columns, partition_by), order_by, partition_by, buckets, forward=True)


def fill_missing_bfill(df: DataFrame, columns: Columns = None, *, order_by: Columns = None,
                       partition_by: Columns = None, buckets: int | None = None) -> DataFrame:
    """Copy the next known value backward in ``order_by`` order; trailing gaps stay.  Series as in forward fill."""
    return _carried(df, _fillable(df, columns, partition_by), order_by, partition_by, buckets, forward=False)


def _fillable(df: DataFrame, columns: Columns, partition_by: Columns, *, numeric: bool = False) -> list[str]:
    series = require(df, partition_by) if partition_by else []
    return [n for n in resolve(df, columns, numeric=numeric) if n not in series]


def _carried(df, names, order_by, partition_by, buckets, *, forward: bool) -> DataFrame:
    if not names:
        return df
    if partition_by:
        return _carried_in_series(df, names, Segmented(df, partition_by, order_by, buckets), forward=forward)
    o = Ordered(df, order_by, buckets)
    key = order_value(o.keys)
    edge = F.max_by if forward else F.min_by
    per_bucket = o.df.groupBy(o.bucket).agg(*[
        edge(present(df, n), F.when(~is_missing(df, n), key)).alias(f"e{i}") for i, n in enumerate(names)])
    across = o.before() if forward else o.after()
    carries = {n: fresh_name(df, f"carry{i}") for i, n in enumerate(names)}
    carry = per_bucket.select(
        o.bucket, *[F.last(f"e{i}", ignorenulls=True).over(across).alias(carries[n]) for i, n in enumerate(names)])

    # both directions use a running frame: a frame open towards the end would be quadratic
    within = o.rows if forward else o.rows_descending
    filled = o.placed.withColumns({n: F.last(present(df, n), ignorenulls=True).over(running(within)) for n in names})
    placed = o.attach(filled, carry)
    return placed.withColumns({n: F.coalesce(col(n), col(carries[n])) for n in names}).select(
        *[col(n) for n in df.columns])


def _carried_in_series(df: DataFrame, names: list[str], s: Segmented, *, forward: bool) -> DataFrame:
    key = order_value(s.keys)
    edge = F.max_by if forward else F.min_by
    edges = {n: f"e{i}" for i, n in enumerate(names)}
    segments = s.segments(s.ordered.df, *[
        edge(present(df, n), F.when(~is_missing(df, n), key)).alias(e) for n, e in edges.items()])
    carries = {e: fresh_name(df, f"carry_{e}") for e in edges.values()}
    within = s.rows if forward else s.rows_descending
    filled = s.placed.withColumns({n: F.last(present(df, n), ignorenulls=True).over(running(within)) for n in names})
    placed = s.attach(filled, s.across(segments, last=list(carries), forward=forward), carries)
    return placed.withColumns({n: F.coalesce(col(n), col(carries[e])) for n, e in edges.items()}).select(
        *[col(n) for n in df.columns])


def interpolate_missing(df: DataFrame, columns: Columns = None, method: str = "linear", *, order_by: Columns = None,
                        partition_by: Columns = None, buckets: int | None = None) -> DataFrame:
    """Estimate numeric gaps from the known values around them, by row position.

    ``linear`` leaves leading gaps and repeats the last value into trailing ones;
    ``nearest`` takes the closer neighbour (the earlier on a tie) and leaves both.
    With ``partition_by`` positions and neighbours are those of the row's own series.
    """
    if method not in ("linear", "nearest"):
        raise ValueError("method must be 'linear' or 'nearest'")
    names = _fillable(df, columns, partition_by, numeric=True)
    if not names:
        return df
    if partition_by:
        return _interpolated_in_series(df, names, method, Segmented(df, partition_by, order_by, buckets))
    o = Ordered(df, order_by, buckets)
    rank, offset = fresh_name(df, "rank"), fresh_name(df, "offset")
    numbered = o.placed.withColumn(rank, F.row_number().over(o.rows).cast("long"))

    def known(n: str, base: Column) -> Column:
        return F.when(~is_missing(df, n), F.struct(base.alias("at"), col(n).cast("double").alias("value")))

    # one row per bucket: its size, its first and its last known value per column
    ends = numbered.groupBy(o.bucket).agg(
        F.count("*").alias("n"),
        *[F.min(known(n, col(rank))).alias(f"first{i}") for i, n in enumerate(names)],
        *[F.max(known(n, col(rank))).alias(f"last{i}") for i, n in enumerate(names)])
    ends = ends.withColumn(offset, F.coalesce(F.sum("n").over(o.before()), F.lit(0)))
    for i in range(len(names)):
        for side in ("first", "last"):
            e = F.col(f"{side}{i}")
            ends = ends.withColumn(f"{side}{i}", F.when(e.isNotNull(), F.struct(
                (e["at"] + col(offset)).alias("at"), e["value"].alias("value"))))
    prev = {n: fresh_name(df, f"prev{i}") for i, n in enumerate(names)}
    nxt = {n: fresh_name(df, f"next{i}") for i, n in enumerate(names)}
    carry = ends.select(
        o.bucket, offset,
        *[F.last(f"last{i}", ignorenulls=True).over(o.before()).alias(prev[n] + "c") for i, n in enumerate(names)],
        *[F.last(f"first{i}", ignorenulls=True).over(o.after()).alias(nxt[n] + "c") for i, n in enumerate(names)])

    up, down = running(o.rows), running(o.rows_descending)
    near = numbered.withColumns(
        {prev[n]: F.last(known(n, col(rank)), ignorenulls=True).over(up) for n in names}).withColumns(
        {nxt[n]: F.last(known(n, col(rank)), ignorenulls=True).over(down) for n in names})
    placed = o.attach(near, carry, offset)

    def globally(name: str) -> Column:
        s = col(name)
        moved = F.when(s.isNotNull(), F.struct((s["at"] + col(offset)).alias("at"), s["value"].alias("value")))
        return F.coalesce(moved, col(name + "c"))

    at = col(rank) + col(offset)
    out = {}
    for n in names:
        out[n] = _estimate(df, n, method, at, globally(prev[n]), globally(nxt[n]))
    return placed.withColumns(out).select(*[col(n) for n in df.columns])


def _estimate(df: DataFrame, n: str, method: str, at: Column, a: Column, b: Column) -> Column:
    """The cell, or what the known neighbours ``a`` and ``b`` (position, value) make of its position."""
    if method == "linear":
        slope = (b["value"] - a["value"]) / (b["at"] - a["at"])
        guess = F.when(b.isNull(), a["value"]).otherwise(slope * (at - a["at"]) + a["value"])
    else:
        guess = F.when(a.isNotNull() & b.isNotNull(),
                       F.when(at - a["at"] <= b["at"] - at, a["value"]).otherwise(b["value"]))
    return F.when(~is_missing(df, n), col(n).cast("double")).when(a.isNotNull(), guess)


def _interpolated_in_series(df: DataFrame, names: list[str], method: str, s: Segmented) -> DataFrame:
    rank, offset = fresh_name(df, "rank"), fresh_name(df, "offset")
    numbered = s.placed.withColumn(rank, F.row_number().over(s.rows).cast("long"))

    def known(n: str, at: Column) -> Column:
        return F.when(~is_missing(df, n), F.struct(at.alias("at"), col(n).cast("double").alias("value")))

    # first the rows of a series in the buckets before: they make places in a segment places in the series
    before = s.across(s.segments(s.ordered.df, F.count("*").alias("rows")), total=["rows"])
    placed = s.attach(numbered, before, {"rows": offset}).withColumn(rank, col(rank) + F.coalesce(col(offset), F.lit(0)))
    firsts, lasts = ({n: f"{side}{i}" for i, n in enumerate(names)} for side in ("first", "last"))
    segments = s.segments(placed, *[F.min(known(n, col(rank))).alias(e) for n, e in firsts.items()],
                          *[F.max(known(n, col(rank))).alias(e) for n, e in lasts.items()])
    carries = {e: fresh_name(df, f"carry_{e}") for e in (*firsts.values(), *lasts.values())}
    near = {e: fresh_name(df, f"near_{e}") for e in carries}
    up, down = running(s.rows), running(s.rows_descending)
    placed = placed.withColumns({near[e]: F.last(known(n, col(rank)), ignorenulls=True).over(up) for n, e in lasts.items()})
    placed = placed.withColumns({near[e]: F.last(known(n, col(rank)), ignorenulls=True).over(down) for n, e in firsts.items()})
    placed = s.attach(placed, s.across(segments, last=list(lasts.values())), {e: carries[e] for e in lasts.values()})
    placed = s.attach(placed, s.across(segments, last=list(firsts.values()), forward=False),
                      {e: carries[e] for e in firsts.values()})
    return placed.withColumns({
        n: _estimate(df, n, method, col(rank), *(F.coalesce(col(near[e]), col(carries[e])) for e in (lasts[n], firsts[n])))
        for n in names}).select(*[col(n) for n in df.columns])


def impute(df: DataFrame, strategy: str, columns: Columns = None, *, value: object = None,
           order_by: Columns = None, partition_by: Columns = None) -> DataFrame:
    """One entry point for the missing-value strategies offered to users.

    ``drop`` looks at whole rows whatever the selection; ``partition_by`` counts for the three strategies that
    depend on row order.
    """
    if strategy == "drop":
        return drop_missing(df)
    if strategy in ("mean", "median", "mode"):
        return fill_missing_statistic(df, strategy, columns)
    if strategy == "ffill":
        return fill_missing_ffill(df, columns, order_by=order_by, partition_by=partition_by)
    if strategy == "bfill":
        return fill_missing_bfill(df, columns, order_by=order_by, partition_by=partition_by)
    if strategy == "interpolate":
        return interpolate_missing(df, columns, order_by=order_by, partition_by=partition_by)
    if strategy == "custom":
        return fill_missing_constant(df, value, columns)
    raise ValueError(f"unknown strategy {strategy!r}")
