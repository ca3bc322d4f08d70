"""Exact medians per group when one group may hold a large part of the table.

Rows are first combined to counts per (group, value), which removes repeated
values in the map tasks.  The value range is cut into buckets; a histogram per
group says which bucket holds the middle ranks, and only those buckets are
ordered, each a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limpid.functions.columns import col, present
from limpid.plans.joins import same_key
from limpid.plans.ordering import bucket_count, bucket_of, split_points


def grouped_median(df: DataFrame, by: Sequence[str], value: str, name: str, *, buckets: int | None = None) -> DataFrame:
    """``by`` columns plus the exact median of ``value``; keys must not be missing."""
    keys = [f"__g{i}" for i in range(len(by))]
    slim = df.select(*[col(b).alias(k) for b, k in zip(by, keys)], present(df, value).cast("double").alias("v"))
    counted = slim.where(F.col("v").isNotNull()).groupBy(*keys, "v").agg(F.count("*").alias("n"))
    splits = split_points(slim.where(F.col("v").isNotNull()), ["v"], buckets or bucket_count(slim))
    medians = _median_of_buckets(counted.withColumn("b", bucket_of(counted, ["v"], splits)), keys)

    # groups whose values are all missing still appear
    groups = slim.select(*keys).distinct()
    gk = groups.select(*[F.col(k).alias("q" + k) for k in keys])
    out = gk.join(medians, same_key([F.col("q" + k) for k in keys], [F.col(k) for k in keys]), "left")
    return out.select(*[F.col("q" + k).alias(b) for k, b in zip(keys, by)], F.col("m").alias(name))


def median_of_counts(counted: DataFrame, by: Sequence[str], *, buckets: int | None = None) -> DataFrame:
    """``by`` columns plus ``m``, the exact median of the doubles ``v``, each there ``n`` times; nothing is missing."""
    keys = [f"__g{i}" for i in range(len(by))]
    named = counted.select(*[col(b).alias(k) for b, k in zip(by, keys)], "v", "n")
    splits = split_points(named, ["v"], buckets or bucket_count(named))
    medians = _median_of_buckets(named.withColumn("b", bucket_of(named, ["v"], splits)), keys)
    return medians.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], "m")


def _median_of_buckets(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``m`` from counts ``n`` per keys and value ``v`` in buckets ``b`` of the value range."""
    # at most one row per group and bucket
    upto = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    histogram = counted.groupBy(*keys, "b").agg(F.sum("n").alias("n"))
    placed = histogram.select(
        *keys, "b", (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(upto).alias("through"), F.sum("n").over(whole).alias("total"))
    lower = F.floor((F.col("total") - 1) / 2)
    upper = F.floor(F.col("total") / 2)
    holding = placed.where(
        ((F.col("before") <= lower) & (F.col("through") > lower))
        | ((F.col("before") <= upper) & (F.col("through") > upper)))

    h = holding.select(*[F.col(k).alias("h" + k) for k in keys], F.col("b").alias("hb"), "before", "total")
    match = same_key([F.col(k) for k in keys], [F.col("h" + k) for k in keys]) & (F.col("b") == F.col("hb"))
    near = counted.join(h, match)
    inside = Window.partitionBy(*keys, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("upto", F.col("before") + F.sum("n").over(inside))
    ranked = ranked.withColumn("from", F.col("upto") - F.col("n"))
    at_lower = (F.col("from") <= lower) & (F.col("upto") > lower)
    at_upper = (F.col("from") <= upper) & (F.col("upto") > upper)
    return ranked.groupBy(*keys).agg(
        ((F.max(F.when(at_lower, F.col("v"))) + F.max(F.when(at_upper, F.col("v")))) / 2).alias("m"))
