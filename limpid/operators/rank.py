"""Sorting, top-n, sampling, ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import col, fresh_name, present, require, require_numeric, type_of
from limpid.plans.fitting import planned
from limpid.plans.ordering import (
    Ordered, bucket_count, order_columns, running, split_points, with_position,
)
from limpid.plans.sizing import MB, plan_bytes

Columns = str | Sequence[str]
#: Up to this many rows a task may hold its candidates in a heap, and up to so many candidates may meet in the last task.
HEAP_ROWS, MEETING_ROWS = 100_000, 10_000_000
#: Bytes of a scan task, where the session does not say.
TASK_BYTES = 128 * MB


def sort_values(
    df: DataFrame, columns: Columns, ascending: bool | Sequence[bool] = True, *, order_by: Columns | None = None
) -> DataFrame:
    """Sort; missing values go last whatever the direction.

    ``order_by`` is the tie-breaker that stands for the original row order.  The
    tie-breaker (a hash of the row when none is given) also lets the range
    partitioning split a value that many rows share.
    """
    names = require(df, columns)
    directions = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    if len(directions) != len(names):
        raise ValueError("ascending needs one entry per column")
    keys = [_last_if_missing(df, n, up) for n, up in zip(names, directions)]
    if order_by:
        return df.orderBy(*keys, *[col(n).asc() for n in require(df, order_by)])
    hashed = [col(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.orderBy(*keys, F.xxhash64(*hashed))


def _last_if_missing(df: DataFrame, name: str, up: bool) -> Column:
    value = present(df, name)
    return value.asc_nulls_last() if up else value.desc_nulls_last()


def _fits_a_heap(df: DataFrame, n: int) -> bool:
    """Whether n candidates of every task are few enough; of a table of unknown size only a handful are."""
    size = plan_bytes(df)
    tasks = MEETING_ROWS // 100 if size is None else size // TASK_BYTES + 1
    return n <= HEAP_ROWS and n * tasks <= MEETING_ROWS


def top_n(df: DataFrame, column: str, n: int = 5, largest: bool = True, *, order_by: Columns) -> DataFrame:
    """The n rows with the largest (smallest) values; ties by ``order_by``, missing only to fill up."""
    require_numeric(df, column)
    order = order_columns(df, order_by)
    if _fits_a_heap(df, n):
        return df.orderBy(_last_if_missing(df, column, not largest), *[col(k).asc() for k in order]).limit(n)
    # too many rows for one heap per task: number the rows in the wanted order instead
    missing, value, place = (fresh_name(df, s) for s in ("missing", "value", "place"))
    exact = "decimal(38,0)" if isinstance(type_of(df, column), T.IntegralType) else "double"
    number = present(df, column).cast(exact)
    keyed = df.withColumn(missing, present(df, column).isNull().cast("int")).withColumn(
        value, F.coalesce(-number if largest else number, F.lit(0).cast(exact)))
    placed = with_position(keyed, [missing, value, *order], place)
    return placed.where(F.col(place) <= n).drop(missing, value, place)


@planned
def _check_enough(df: DataFrame, n: int) -> None:
    rows = df.count()
    if n > rows:
        raise ValueError(f"cannot sample {n} rows from {rows}")


def sample_rows(df: DataFrame, n: int = 5, random_state: int = 42, *, order_by: Columns) -> DataFrame:
    """Exactly n rows: those with the smallest MD5 of seed and key, so the same under any partitioning and engine."""
    keys = order_columns(df, order_by)
    _check_enough(df, n)
    ticket = F.md5(F.concat_ws("|", F.lit(str(random_state)), *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]))
    name, place = fresh_name(df, "ticket"), fresh_name(df, "place")
    drawn = df.withColumn(name, ticket)
    if _fits_a_heap(df, n):
        return drawn.orderBy(name, *[col(k) for k in keys]).limit(n).drop(name)
    return with_position(drawn, [name, *keys], place).where(F.col(place) <= n).drop(name, place)


def add_rank(
    df: DataFrame, column: str, new_column: str | None = None, ascending: bool = False, *, buckets: int | None = None
) -> DataFrame:
    """Rank with the average on ties; the largest value is 1 by default, missing stays missing.

    Ranks are worked out once per distinct value, in buckets of the value range,
    and joined back, so neither a global window nor a shared value needs one task.
    """
    require(df, column)
    new_column = new_column or f"{column}_Rank"
    value, rank = fresh_name(df, "value"), fresh_name(df, "rank")
    slim = df.select(present(df, column).alias(value)).where(F.col(value).isNotNull())
    counted = slim.groupBy(value).agg(F.count("*").alias("n"))
    splits = split_points(slim, [value], buckets or bucket_count(slim))
    o = Ordered(counted, value, splits=splits)

    sizes = o.df.groupBy(o.bucket).agg(F.sum("n").alias("n"))
    offsets = sizes.select(
        o.bucket, F.coalesce(F.sum("n").over(o.before()), F.lit(0)).alias("offset"),
        F.coalesce(F.sum("n").over(o.after()), F.lit(0)).alias("beyond"))
    here = F.sum("n").over(running(o.rows if ascending else o.rows_descending))
    start = "offset" if ascending else "beyond"
    ranks = o.attach(o.placed.withColumn("upto", here), offsets, "offset", "beyond").select(
        value, (F.col("upto") + F.col(start) - F.col("n") + (F.col("n") + 1) / 2).alias(rank))
    joined = df.join(ranks, present(df, column) == F.col(value), "left")
    kept = [col(n) for n in df.columns if n != new_column]
    if new_column in df.columns:
        return joined.select(*[F.col(rank).alias(n) if n == new_column else col(n) for n in df.columns])
    return joined.select(*kept, F.col(rank).alias(new_column))
