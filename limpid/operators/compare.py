"""Before/after comparison and the numbers behind the charts."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    as_number, is_datetime_type, is_numeric_type, require, resolve,
)
from limpid.operators.dedupe import duplicate_count
from limpid.operators.profile import missing_summary
from limpid.plans.fitting import fitted
from limpid.plans.quantiles import exact_quantiles

BINS = 20
WHISKER = 1.5


def snapshot(df: DataFrame) -> DataFrame:
    """``(metric, column, value)``: rows, duplicate rows and missing cells per column."""
    nothing = F.lit(None).cast("string").alias("column")
    rows = df.agg(F.count("*").alias("value")).select(F.lit("rows").alias("metric"), nothing, "value")
    twins = duplicate_count(df).select(
        F.lit("duplicate_rows").alias("metric"), nothing, F.col("duplicate_rows").alias("value"))
    gaps = missing_summary(df, all_columns=True).select(
        F.lit("missing").alias("metric"), "column", F.col("missing").alias("value"))
    return rows.unionByName(twins).unionByName(gaps)


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(metric, column, before, after)``; a column found on one side only has one value."""
    left = snapshot(before).withColumnRenamed("value", "before")
    right = snapshot(after).select(F.col("metric").alias("m"), F.col("column").alias("c"), F.col("value").alias("after"))
    joined = left.join(right, (F.col("metric") == F.col("m")) & F.col("column").eqNullSafe(F.col("c")), "full")
    return joined.select(F.coalesce("metric", "m").alias("metric"), F.coalesce("column", "c").alias("column"),
                         "before", "after")


def missing_values_bar(df: DataFrame) -> DataFrame:
    """``(column, missing)`` bars; no rows when nothing is missing."""
    return missing_summary(df)


def is_plottable(df: DataFrame, column: str) -> DataFrame:
    """One row ``(column, plottable)``: whether any cell reads as a number."""
    require(df, column)
    return df.agg(F.lit(column).alias("column"), (F.count(as_number(df, column)) > 0).alias("plottable"))


def _both_sides(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    parts = []
    for side, df in (("before", before), ("after", after)):
        require(df, column)
        parts.append(df.select(F.lit(side).alias("side"), as_number(df, column).alias("x")))
    return parts[0].unionByName(parts[1]).where(F.col("x").isNotNull())


@fitted
def _bin_edges(values: DataFrame, bins: int) -> list[float]:
    row = values.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    low, high = (0.0, 1.0) if row["low"] is None else (row["low"], row["high"])
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def _bin_of(x: Column, edges: list[float]) -> Column:
    """Index of the half-open bin; the last one is closed.

    The division may land one bin off next to an edge, so the result is checked
    against the edges themselves.
    """
    bins = len(edges) - 1
    points = F.lit(edges)
    guess = F.least(F.floor((x - edges[0]) / ((edges[-1] - edges[0]) / bins)), F.lit(bins - 1)).cast("int")
    lower = F.get(points, guess)
    upper = F.get(points, guess + 1)
    return F.when(x < lower, guess - 1).when((x >= upper) & (guess < bins - 1), guess + 1).otherwise(guess)


def histogram_comparison(before: DataFrame, after: DataFrame, column: str, *, bins: int = BINS) -> DataFrame:
    """``(side, bin, lower, upper, count)`` over equal bins shared by both sides, empty bins included."""
    values = _both_sides(before, after, column)
    edges = _bin_edges(values, bins)
    counted = values.select("side", _bin_of(F.col("x"), edges).alias("bin")).groupBy("side", "bin").agg(
        F.count("*").alias("count"))
    frame = before.sparkSession.createDataFrame(
        [(s, i, edges[i], edges[i + 1]) for s in ("before", "after") for i in range(bins)],
        "side string, bin int, lower double, upper double")
    # two rows per bin on either side
    return frame.join(F.broadcast(counted), ["side", "bin"], "left").select(
        "side", "bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count"))


def boxplot_comparison(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """``(side, n, q1, median, q3, whisker_low, whisker_high, n_fliers)`` for both sides."""
    boxes = [_box(before, column, "before"), _box(after, column, "after")]
    return boxes[0].unionByName(boxes[1])


def _box(df: DataFrame, column: str, side: str) -> DataFrame:
    require(df, column)
    x = as_number(df, column)
    q1, median, q3 = exact_quantiles(df, {"x": x}, [0.25, 0.5, 0.75])["x"]
    box = [F.lit(side).alias("side"), F.count(x).alias("n")]
    box += [F.lit(v).cast("double").alias(n) for n, v in (("q1", q1), ("median", median), ("q3", q3))]
    if q1 is None:
        empty = F.lit(None).cast("double")
        return df.agg(*box, empty.alias("whisker_low"), empty.alias("whisker_high"),
                      F.count_if(F.lit(False)).alias("n_fliers"))
    low, high = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
    inside_low = F.least(F.min(F.when(x >= low, x)), F.lit(q1))
    inside_high = F.greatest(F.max(F.when(x <= high, x)), F.lit(q3))
    return df.agg(*box, inside_low.alias("whisker_low"), inside_high.alias("whisker_high"),
                  F.count_if((x < low) | (x > high)).alias("n_fliers"))


def boxplot_fliers(df: DataFrame, column: str) -> DataFrame:
    """The flier values themselves, one row each."""
    x = as_number(df, column)
    q1, q3 = exact_quantiles(df, {"x": x}, [0.25, 0.75])["x"]
    values = df.select(x.alias("flier"))
    if q1 is None:
        return values.where(F.lit(False))
    low, high = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
    return values.where((F.col("flier") < low) | (F.col("flier") > high))


def dtype_breakdown(df: DataFrame) -> DataFrame:
    """``(family, n_columns)`` from the schema alone."""
    families: dict[str, int] = {}
    for f in df.schema:
        if is_numeric_type(f.dataType):
            family = "numeric"
        elif is_datetime_type(f.dataType):
            family = "datetime"
        elif isinstance(f.dataType, T.BooleanType):
            family = "boolean"
        else:
            family = "text/categorical"
        families[family] = families.get(family, 0) + 1
    return df.sparkSession.createDataFrame(sorted(families.items()), "family string, n_columns int")


#: Up to so many columns every pair has aggregates of its own, in generated code.
PAIRED_COLUMNS = 16
#: A spread this small against the second moment is what rounding leaves of a constant.
NO_SPREAD = 1e-13


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, *, paired: int = PAIRED_COLUMNS) -> DataFrame:
    """``(column_a, column_b, corr)``: Pearson over rows where both are there.

    A constant column has no correlation, and fewer than two numeric columns give no rows.  Up to ``paired`` columns
    all pairs share one aggregation; more go through one matrix of moments.
    """
    names = resolve(df, columns, numeric=True)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    slim = df.select(*[as_number(df, n).alias(f"x{i}") for i, n in enumerate(names)])
    if len(names) > paired:
        rows = [(names[i], names[j], r) for i, j, r in _correlations(slim)]
        return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, corr double")
    aggs, cells = [], []
    for i in range(len(names)):
        for j in range(i, len(names)):
            a = F.when(F.col(f"x{j}").isNotNull(), F.col(f"x{i}"))
            b = F.when(F.col(f"x{i}").isNotNull(), F.col(f"x{j}"))
            spread = F.stddev_pop(a) * F.stddev_pop(b)
            # merged deviations of a constant can differ from zero by rounding
            varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
            r = F.when(varies, F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)))
            bounded = F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)
            if i == j:
                bounded = F.when(r.isNotNull(), F.lit(1.0))
            aggs.append(bounded.alias(f"r{i}_{j}"))
            pair = [(names[i], names[j])] if i == j else [(names[i], names[j]), (names[j], names[i])]
            cells += [F.struct(F.lit(p).alias("column_a"), F.lit(q).alias("column_b"),
                               F.col(f"r{i}_{j}").alias("corr")) for p, q in pair]
    return slim.agg(*aggs).select(F.inline(F.array(*cells)))


def _correlations(slim: DataFrame) -> list[tuple[int, int, float | None]]:
    """Correlations of all pairs of double columns from counts, sums and products of the rows where both are there.

    Columns are first brought to mean 0 and deviation 1, so that nothing cancels out.  A row then is the vector of
    its values (0 for a gap), of their squares and of the marks of what is there; the sum of its products with itself
    holds everything, for every pair over its own rows.  The partial matrices are added up in a tree; the result has
    nine numbers per pair of columns, whatever the rows.
    """
    size = len(slim.columns)
    found = slim.agg(*[f(c).alias(f"{name}{i}") for i, c in enumerate(slim.columns) for name, f in (
        ("mean", F.avg), ("std", F.stddev_pop), ("low", F.min), ("high", F.max))]).first()
    spread = [found[f"std{i}"] if found[f"low{i}"] != found[f"high{i}"] else None for i in range(size)]
    if not any(spread):
        return [(i, j, None) for i in range(size) for j in range(size)]
    scaled = [F.coalesce((F.col(c) - F.lit(found[f"mean{i}"])) / F.lit(spread[i]), F.lit(0.0)) if spread[i] else F.lit(0.0)
              for i, c in enumerate(slim.columns)]
    there = [F.col(c).isNotNull().cast("double") for c in slim.columns]
    rows = slim.select(*[v.alias(f"v{i}") for i, v in enumerate(scaled)], *[t.alias(f"t{i}") for i, t in enumerate(there)])
    values = [F.col(f"v{i}") for i in range(size)]
    vector = array_to_vector(F.array(*values, *[v * v for v in values], *[F.col(f"t{i}") for i in range(size)]))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(vector.alias("row")), "row")
    sums = RowMatrix(vectors, 0, 3 * size).computeGramianMatrix().toArray()
    products, second, count = sums[:size, :size], sums[size:2 * size, 2 * size:], sums[2 * size:, 2 * size:]
    first = sums[:size, 2 * size:]
    out = []
    for i in range(size):
        for j in range(size):
            n = count[i, j]
            if not (n and spread[i] and spread[j]):
                out.append((i, j, None))
                continue
            means = first[i, j] / n, first[j, i] / n
            squares = second[i, j] / n, second[j, i] / n
            spreads = [s - m * m for s, m in zip(squares, means)]
            if any(v <= NO_SPREAD * max(s, NO_SPREAD) for v, s in zip(spreads, squares)):
                out.append((i, j, None))
            else:
                r = (products[i, j] / n - means[0] * means[1]) / math.sqrt(spreads[0] * spreads[1])
                out.append((i, j, 1.0 if i == j else max(-1.0, min(1.0, float(r)))))
    return out
