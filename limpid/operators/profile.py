"""Read-only health reports.  Everything that fits in one aggregation is one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.columns import as_number, is_missing, is_numeric_type, present, resolve, type_of
from limpid.operators.dedupe import duplicate_count
from limpid.plans.frequencies import distinct_counts, top_values
from limpid.plans.quantiles import exact_quantiles

TEXT_SECTIONS = ("shape", "types", "missing", "duplicates", "unique", "numeric")


def _rows_from(wide: DataFrame, rows: list[Mapping[str, Column]]) -> DataFrame:
    """Turn one aggregate row into several rows."""
    cells = F.array(*[F.struct(*[c.alias(n) for n, c in r.items()]) for r in rows])
    return wide.select(F.inline(cells))


def _nothing(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def basic_info(df: DataFrame) -> DataFrame:
    """One row: ``rows, columns, total_cells, dimensions``."""
    width = len(df.columns)
    return df.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(width).alias("columns"), (F.col("rows") * width).alias("total_cells"),
        F.lit(2).alias("dimensions"))


def dtypes_summary(df: DataFrame) -> DataFrame:
    """``(column, dtype)`` in column order; no job over the data."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column string, dtype string")


def _missing_counts(df: DataFrame) -> DataFrame:
    """``(column, missing, rows)`` for every column, from one pass."""
    if not df.columns:
        return _nothing(df, "column string, missing bigint, rows bigint")
    wide = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(df, n)).alias(f"c{i}") for i, n in enumerate(df.columns)])
    return _rows_from(wide, [
        {"column": F.lit(n), "missing": F.col(f"c{i}"), "rows": F.col("rows")} for i, n in enumerate(df.columns)])


def missing_summary(df: DataFrame, *, all_columns: bool = False) -> DataFrame:
    """``(column, missing)``, only for columns with gaps unless ``all_columns``."""
    counts = _missing_counts(df)
    if not all_columns:
        counts = counts.where(F.col("missing") > 0)
    return counts.select("column", "missing")


def missing_percent(df: DataFrame) -> DataFrame:
    """``(column, percent)`` of the rows, two decimals, only for columns with gaps."""
    share = F.bround(F.try_divide(F.col("missing") * 100.0, F.col("rows")), 2)
    return _missing_counts(df).where(F.col("missing") > 0).select("column", share.alias("percent"))


def unique_counts(df: DataFrame, *, approximate: float | None = None) -> DataFrame:
    """``(column, n_unique)``: distinct values that are there.

    Exact by default.  ``approximate`` is a relative error to accept instead; the
    counts then come from one aggregation that shuffles no values.
    """
    if not df.columns:
        return _nothing(df, "column string, n_unique bigint")
    if approximate is not None:
        wide = df.agg(*[
            F.approx_count_distinct(present(df, n), approximate).alias(f"c{i}") for i, n in enumerate(df.columns)])
        return _rows_from(wide, [
            {"column": F.lit(n), "n_unique": F.col(f"c{i}")} for i, n in enumerate(df.columns)])
    return distinct_counts(df, df.columns)


def _numeric_columns(df: DataFrame) -> list[str]:
    return resolve(df, numeric=True)


def numeric_summary(df: DataFrame) -> DataFrame:
    """``(column, mean, median, std, min, max)`` of numeric columns; population deviation."""
    names = _numeric_columns(df)
    if not names:
        return _nothing(df, "column string, mean double, median double, std double, min double, max double")
    values = {n: as_number(df, n) for n in names}
    medians = exact_quantiles(df, values, [0.5])
    aggs = []
    for i, v in enumerate(values.values()):
        aggs += [F.avg(v).alias(f"mean{i}"), F.stddev_pop(v).alias(f"std{i}"),
                 F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
    return _rows_from(df.agg(*aggs), [{
        "column": F.lit(n), "mean": F.col(f"mean{i}"), "median": F.lit(medians[n][0]).cast("double"),
        "std": F.col(f"std{i}"), "min": F.col(f"min{i}"), "max": F.col(f"max{i}"),
    } for i, n in enumerate(names)])


def describe(df: DataFrame) -> DataFrame:
    """One row per column: ``count``; ``unique, top, freq`` for text; the statistics for numbers.

    The deviation is the sample one; a tie for ``top`` goes to the smallest value.
    """
    numeric = _numeric_columns(df)
    other = [n for n in df.columns if n not in numeric]
    quartiles = exact_quantiles(df, {n: as_number(df, n) for n in numeric}, [0.25, 0.5, 0.75])
    aggs = [F.count(F.when(~is_missing(df, n), 1)).alias(f"n{i}") for i, n in enumerate(df.columns)]
    for i, n in enumerate(df.columns):
        if n in numeric:
            v = as_number(df, n)
            aggs += [F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                     F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
    none = F.lit(None).cast("double")
    rows = []
    for i, n in enumerate(df.columns):
        is_number = n in numeric
        q = [F.lit(x).cast("double") for x in quartiles[n]] if is_number else [none] * 3
        rows.append({
            "column": F.lit(n), "count": F.col(f"n{i}"),
            "mean": F.col(f"mean{i}") if is_number else none, "std": F.col(f"std{i}") if is_number else none,
            "min": F.col(f"min{i}") if is_number else none, "p25": q[0], "p50": q[1], "p75": q[2],
            "max": F.col(f"max{i}") if is_number else none})
    stats = _rows_from(df.agg(*aggs), rows)
    if other:
        # one row per column on either side
        stats = stats.join(F.broadcast(top_values(df, other)), "column", "left")
    else:
        stats = stats.withColumns({
            "unique": F.lit(None).cast("long"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("long")})
    return stats.select("column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")


def full_report(df: DataFrame) -> DataFrame:
    """The whole profile in long form: ``(section, column, metric, value)``, value as text."""

    def part(section: str, frame: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
        name = F.col("column") if "column" in frame.columns and "rows" not in frame.columns else F.lit(None).cast("string")
        cells = F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(c).cast("string").alias("value")) for m, c in metrics.items()])
        return frame.select(F.lit(section).alias("section"), name.alias("column"), F.inline(cells))

    missing = _missing_counts(df).where(F.col("missing") > 0).withColumn(
        "percent", F.bround(F.col("missing") * 100.0 / F.col("rows"), 2)).drop("rows")
    parts = [
        part("shape", basic_info(df), {"rows": "rows", "columns": "columns", "total_cells": "total_cells"}),
        part("types", dtypes_summary(df), {"dtype": "dtype"}),
        part("missing", missing, {"missing": "missing", "percent": "percent"}),
        part("duplicates", duplicate_count(df), {"duplicate_rows": "duplicate_rows"}),
        part("unique", unique_counts(df), {"unique": "n_unique"}),
    ]
    if any(is_numeric_type(type_of(df, n)) for n in df.columns):
        parts.append(part("numeric", numeric_summary(df), {m: m for m in ("mean", "median", "std", "min", "max")}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_text(report: DataFrame, columns: list[str]) -> list[str]:
    """Lines of a readable report; a profile has a few rows per column, so it is collected."""
    rows = report.collect()
    place = {c: i for i, c in enumerate(columns)}
    lines = ["DATA PROFILE"]
    for section in TEXT_SECTIONS:
        here = [r for r in rows if r["section"] == section]
        lines += ["", f"[{section}]"]
        if not here:
            lines.append("  none")
        by_column: dict[str | None, list[str]] = {}
        for r in here:
            by_column.setdefault(r["column"], []).append(f"{r['metric']}={_readable(r['value'], section)}")
        for name in sorted(by_column, key=lambda c: place.get(c, -1)):
            lines.append("  " + (f"{name}: " if name is not None else "") + ", ".join(by_column[name]))
    return lines


def _readable(value: str | None, section: str) -> str:
    if value is None:
        return "n/a"
    return f"{float(value):.2f}" if section == "numeric" else value
