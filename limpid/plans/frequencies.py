"""Value frequencies of many columns at once, as a combinable group-by.

Columns of one type share one pass; the count per (column, value) is combined
in the map tasks, so a value held by a third of all rows sends one row per
task.  Mode, top value and distinct counts are all read from this table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import col, fingerprint, present, type_of
from limpid.plans.fitting import fitted


def _by_type(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for name in columns:
        groups.setdefault(type_of(df, name).simpleString(), []).append(name)
    return groups


def frequencies(df: DataFrame, columns: Sequence[str], cell=present) -> list[DataFrame]:
    """One DataFrame ``(column, value, n)`` per column type; missing values are left out.

    ``cell`` is what stands for a cell: its value, or its fingerprint where only
    equality matters.
    """
    tables = []
    for names in _by_type(df, columns).values():
        slim = df.select(*[cell(df, n).alias(n) for n in names])
        if len(names) == 1:
            long = slim.select(F.lit(names[0]).alias("column"), col(names[0]).alias("value"))
        else:
            long = slim.unpivot([], [col(n) for n in names], "column", "value")
        tables.append(
            long.where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("n")))
    return tables


def _per_column(table: DataFrame) -> DataFrame:
    """``(column, unique, top, freq)``; the smallest value wins a tie."""
    best = F.min(F.struct((-F.col("n")).alias("fewer"), F.col("value")))
    return table.groupBy("column").agg(F.count("*").alias("unique"), best.alias("best")).select(
        "column", "unique", F.col("best.value").alias("top"), (-F.col("best.fewer")).alias("freq"))


@fitted
def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[object, int]]:
    """The most frequent value per column and its count; ties go to the smallest value.

    One row per column reaches the driver.  Columns without values are absent.
    """
    found: dict[str, tuple[object, int]] = {}
    for table in frequencies(df, columns):
        for r in _per_column(table).collect():
            found[r["column"]] = (r["top"], r["freq"])
    return found


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, unique, top, freq)`` with the top value as text, for description tables."""
    parts = [_per_column(t).withColumn("top", F.col("top").cast("string")) for t in frequencies(df, columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), (T.IntegralType, T.DateType))


def _marked_words(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, n_unique)`` of whole numbers and dates: every 64 neighbouring values share one word of marks.

    What is shuffled is one row per column and word instead of one per value, and never more.
    """
    numbers = [(F.unix_date(col(n)) if isinstance(type_of(df, n), T.DateType) else col(n)).cast("long").alias(n) for n in names]
    slim = df.select(*numbers)
    long = slim.unpivot([], [col(n) for n in names], "column", "value") if len(names) > 1 else slim.select(
        F.lit(names[0]).alias("column"), col(names[0]).alias("value"))
    mark = F.expr("shiftleft(1L, cast(value & 63 AS int))")
    words = long.where(F.col("value").isNotNull()).groupBy("column", F.shiftright("value", 6).alias("word")).agg(
        F.bit_or(mark).alias("marks"))
    return words.groupBy("column").agg(F.sum(F.bit_count("marks")).alias("n_unique"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_unique)`` for every named column, in no particular order."""
    spark = df.sparkSession
    names = spark.createDataFrame([(n,) for n in columns], T.StructType([T.StructField("column", T.StringType())]))
    whole = [n for n in columns if _is_whole(df, n)]
    out = _marked_words(df, whole) if whole else None
    for table in frequencies(df, [n for n in columns if n not in whole], fingerprint):
        part = table.groupBy("column").agg(F.count("*").alias("n_unique"))
        out = part if out is None else out.unionByName(part)
    # columns without values count 0; there is one row per column to add up
    return names.withColumn("n_unique", F.lit(0).cast("long")).unionByName(out).groupBy("column").agg(
        F.sum("n_unique").alias("n_unique"))


@fitted
def distinct_values(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list]:
    """The sorted values of each column, all columns of a type from one pass; more than ``most`` in one raise.

    No more than ``most`` times the columns and one row reach the driver; with that one, some column has too many.
    """
    found: dict[str, list] = {n: [] for n in columns}
    for table in frequencies(df, columns):
        for r in table.select("column", "value").limit(most * len(columns) + 1).collect():
            found[r["column"]].append(r["value"])
    name, values = max(found.items(), key=lambda item: len(item[1]), default=("", []))
    if len(values) > most:
        raise ValueError(f"column {name!r} has more than {most} values to encode")
    return {n: sorted(values) for n, values in found.items()}
