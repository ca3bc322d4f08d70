"""Row-order work without a single-task window.

The table is cut into buckets at literal split points of its order key.  A
bucket is a deterministic function of the row's own key, so recomputed tasks
agree with each other.  Windows run inside buckets; what has to cross from one
bucket to the next (a row count, the last known value) is one row per bucket,
prefix-summed over the bucket table and joined back.  That table has at most
``MAX_BUCKETS`` rows, which is what makes broadcasting it safe.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from limpid.functions.columns import col, fresh_name, require, type_of
from limpid.plans.fitting import planned
from limpid.plans.sizing import MB, plan_bytes

MAX_BUCKETS = 16_384
BUCKET_BYTES = 128 * MB
SAMPLES_PER_BUCKET = 20
SMALL_INPUT_BUCKETS = 200


def order_columns(df: DataFrame, order_by: str | Sequence[str] | None) -> list[str]:
    if not order_by:
        raise ValueError("this operator depends on row order: pass order_by=<unique key column(s)>")
    return require(df, order_by)


def order_value(keys: Sequence[str]) -> Column:
    """One comparable value for a simple or composite key."""
    return col(keys[0]) if len(keys) == 1 else F.struct(*[col(k) for k in keys])


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the estimated size asks for, and enough to keep small inputs parallel."""
    size = plan_bytes(df)
    by_size = MAX_BUCKETS if size is None else size // BUCKET_BYTES + 1
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MAX_BUCKETS, max(by_size, min(partitions, SMALL_INPUT_BUCKETS))))


@planned
def split_points(df: DataFrame, keys: Sequence[str], buckets: int, seed: int = 17) -> list[tuple[str, ...]]:
    """Bucket boundaries from a bounded sample of the key, as text that casts back exactly."""
    if buckets <= 1:
        return []
    only_keys = df.select(*[col(k) for k in keys])
    wanted = buckets * SAMPLES_PER_BUCKET
    rows = only_keys.count()
    sample = only_keys if rows <= wanted else only_keys.sample(wanted / rows, seed=seed)
    texts = sample.distinct().orderBy(*[col(k) for k in keys]).select(
        *[col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]).collect()
    picked = []
    for i in range(1, buckets):
        at = i * len(texts) // buckets
        if 0 < at < len(texts) and (not picked or tuple(texts[at]) != picked[-1]):
            picked.append(tuple(texts[at]))
    return picked


def bucket_of(df: DataFrame, keys: Sequence[str], splits: Sequence[tuple[str, ...]]) -> Column:
    """Number of split points that are at or below the row's key."""
    if not splits:
        return F.lit(0)
    key = order_value(keys)
    if len(keys) == 1:
        # one text literal is far cheaper to plan than thousands of separate ones
        texts = F.from_json(F.lit(json.dumps([s[0] for s in splits])), "array<string>")
        points = texts.cast(f"array<{type_of(df, keys[0]).simpleString()}>")
    else:
        points = F.array(*[
            F.struct(*[F.lit(part).cast(type_of(df, k)).alias(k) for part, k in zip(s, keys)])
            for s in splits])
    if len(splits) <= 32:
        total = F.lit(0)
        for i in range(len(splits)):
            total = total + F.coalesce((F.get(points, F.lit(i)) <= key).cast("int"), F.lit(0))
        return total
    # binary search over the literal array
    steps = F.sequence(F.lit(1), F.lit(len(splits).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        right = F.coalesce(F.get(points, mid) <= key, F.lit(False)) & (acc["lo"] < acc["hi"])
        return F.struct(
            F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def running(window: WindowSpec) -> WindowSpec:
    """Frame from the start of the window to the current row, linear in the rows.

    Frames open towards the end are evaluated in quadratic time, so look-ahead
    uses this frame on the reversed order instead.
    """
    return window.rowsBetween(Window.unboundedPreceding, 0)


class Ordered:
    """A table cut into ordered buckets, with the names of its helper columns."""

    def __init__(self, df: DataFrame, order_by: str | Sequence[str] | None, buckets: int | None = None,
                 *, splits: Sequence[tuple[str, ...]] | None = None):
        self.keys = order_columns(df, order_by)
        self.bucket = fresh_name(df, "bucket")
        if splits is None:
            splits = split_points(df, self.keys, min(buckets or bucket_count(df), MAX_BUCKETS))
        self.single, self.buckets = not splits, len(splits) + 1
        self.df = df.withColumn(self.bucket, bucket_of(df, self.keys, splits))

    @property
    def rows(self) -> WindowSpec:
        """Rows of one bucket in key order."""
        return Window.partitionBy(self.bucket).orderBy(*[col(k).asc_nulls_first() for k in self.keys])

    @property
    def rows_descending(self) -> WindowSpec:
        """Rows of one bucket in reverse key order."""
        return Window.partitionBy(self.bucket).orderBy(*[col(k).desc_nulls_last() for k in self.keys])

    @property
    def placed(self) -> DataFrame:
        """The rows dealt by bucket to as many tasks as there are buckets, whatever the session's shuffle partitions."""
        return self.df if self.single else self.df.repartition(self.buckets, self.bucket)

    def before(self) -> WindowSpec:
        """All buckets before the current one; over the bucket table only (bounded rows)."""
        return Window.orderBy(F.col(self.bucket).asc()).rowsBetween(Window.unboundedPreceding, -1)

    def after(self) -> WindowSpec:
        """All buckets after the current one, nearest last."""
        return Window.orderBy(F.col(self.bucket).desc()).rowsBetween(Window.unboundedPreceding, -1)

    def attach(self, df: DataFrame, per_bucket: DataFrame, *counts: str) -> DataFrame:
        """Join the bucket table (at most MAX_BUCKETS rows) back onto the rows.

        What it holds comes from other buckets, so a single bucket needs no join:
        nothing is carried and the named ``counts`` are zero.
        """
        if self.single:
            return df.withColumns({
                f.name: F.lit(0 if f.name in counts else None).cast(f.dataType)
                for f in per_bucket.schema if f.name != self.bucket})
        return df.join(F.broadcast(per_bucket), self.bucket, "left")


def with_position(
    df: DataFrame, order_by: str | Sequence[str], name: str, *, buckets: int | None = None
) -> DataFrame:
    """Add the 1-based global row position in key order as a long."""
    o = Ordered(df, order_by, buckets)
    offset = fresh_name(df, "offset")
    counts = o.df.groupBy(o.bucket).agg(F.count("*").alias("n"))
    offsets = counts.select(o.bucket, F.coalesce(F.sum("n").over(o.before()), F.lit(0)).alias(offset))
    numbered = o.placed.withColumn(name, F.row_number().over(o.rows).cast("long"))
    placed = o.attach(numbered, offsets, offset)
    return placed.withColumn(name, col(name) + col(offset)).drop(o.bucket, offset)


class Segmented:
    """Rows ordered inside series; a large series is spread over as many buckets as its rows fill.

    Buckets cut the common order of (series, order key), so their sizes don't depend on the sizes of the series.
    The rows of one series in one bucket are a segment.  Only a bucket's first series can reach into earlier
    buckets and only its last one into later ones, so one row per bucket says all that crosses, whatever the
    number of series.  Rows whose series is missing are a series of their own.
    """

    def __init__(self, df: DataFrame, partition_by: str | Sequence[str], order_by: str | Sequence[str] | None,
                 buckets: int | None = None):
        self.series, self.keys = require(df, partition_by), order_columns(df, order_by)
        self.ordered = Ordered(df, [*self.series, *(k for k in self.keys if k not in self.series)], buckets)
        self.bucket, self.single = self.ordered.bucket, self.ordered.single
        self.placed = self.ordered.placed

    @property
    def rows(self) -> WindowSpec:
        """Rows of one segment in key order."""
        return self._segment().orderBy(*[col(k).asc_nulls_first() for k in self.keys])

    @property
    def rows_descending(self) -> WindowSpec:
        """Rows of one segment in reverse key order."""
        return self._segment().orderBy(*[col(k).desc_nulls_last() for k in self.keys])

    def _segment(self):
        return Window.partitionBy(self.bucket, *[col(k) for k in self.series])

    def _series(self) -> Column:
        return F.struct(*[col(k).alias(f"s{i}") for i, k in enumerate(self.series)])

    def segments(self, df: DataFrame, *aggregates: Column) -> DataFrame:
        """One row per segment."""
        return df.groupBy(self.bucket, *[col(k) for k in self.series]).agg(*aggregates)

    def across(self, segments: DataFrame, *, last: Sequence[str] = (), total: Sequence[str] = (),
               forward: bool = True) -> DataFrame:
        """One row per bucket (at most MAX_BUCKETS): what its first series brings along from earlier buckets.

        ``last`` names columns whose nearest known value is carried, ``total`` columns that are summed up.
        Backwards it is the last series and what comes from later buckets.
        """
        series, given = self._series(), F.struct(*[F.col(n) for n in (*last, *total)])
        first, final = (F.min, F.max_by) if forward else (F.max, F.min_by)
        other = F.max if forward else F.min
        ends = segments.groupBy(self.bucket).agg(
            first(series).alias("asks"), other(series).alias("gives"), final(given, series).alias("given"))
        gives = ends.select(self.bucket, F.col("gives").alias("series"), "given", F.lit(1).alias("turn"))
        asks = ends.select(self.bucket, F.col("asks").alias("series"),
                           F.lit(None).cast(ends.schema["given"].dataType).alias("given"), F.lit(0).alias("turn"))
        by_bucket = F.col(self.bucket).asc() if forward else F.col(self.bucket).desc()
        seen = running(Window.partitionBy("series").orderBy(by_bucket, "turn"))
        return gives.unionByName(asks).select(
            self.bucket, "series", "turn",
            *[F.last(F.col("given")[n], ignorenulls=True).over(seen).alias(n) for n in last],
            *[F.sum(F.coalesce(F.col("given")[n], F.lit(0))).over(seen).alias(n) for n in total],
        ).where("turn = 0").drop("turn")

    def attach(self, df: DataFrame, carried: DataFrame, names: dict[str, str]) -> DataFrame:
        """Add the columns ``names`` (carried name: new name); rows that nothing is carried to get NULL."""
        if self.single:
            return df.withColumns({new: F.lit(None).cast(carried.schema[old].dataType) for old, new in names.items()})
        table = carried.select(F.col(self.bucket).alias("__at"), F.col("series").alias("__series"),
                               *[F.col(old).alias(new) for old, new in names.items()])
        same = (col(self.bucket) == F.col("__at")) & self._series().eqNullSafe(F.col("__series"))
        return df.join(F.broadcast(table), same, "left").drop("__at", "__series")


def with_series_position(df: DataFrame, partition_by: str | Sequence[str], order_by: str | Sequence[str], name: str, *,
                         buckets: int | None = None) -> DataFrame:
    """Add the 1-based position of a row inside its series, in key order, as a long."""
    s = Segmented(df, partition_by, order_by, buckets)
    carried = s.across(s.segments(s.ordered.df, F.count("*").alias("n")), total=["n"])
    offset = fresh_name(df, "offset")
    numbered = s.placed.withColumn(name, F.row_number().over(s.rows).cast("long"))
    placed = s.attach(numbered, carried, {"n": offset})
    return placed.withColumn(name, col(name) + F.coalesce(col(offset), F.lit(0))).drop(s.bucket, offset)
