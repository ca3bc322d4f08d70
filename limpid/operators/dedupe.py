"""Duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import col, fingerprint, fresh_name, nan_to_null, present, require, type_of
from limpid.plans.ordering import order_columns, order_value
from limpid.plans.sizing import GB, input_bytes

#: Places of the filter that tells rows apart; its 64-bit words make at most 2^20 rows of 16 bytes to broadcast.
FILTER_PLACES = 1 << 26
#: Up to this estimate the rows are simply grouped; beyond, only those that may have a twin are.
GROUPED_BYTES = GB


def drop_duplicates(
    df: DataFrame,
    subset: str | Sequence[str] | None = None,
    keep: str | bool = "first",
    *,
    order_by: str | Sequence[str] | None = None,
    suspects_only: bool | None = None,
) -> DataFrame:
    """Drop repeated rows; missing equals missing.

    Whole rows need no order.  With ``subset``, ``keep`` picks the first or last
    row in ``order_by`` order, and ``keep=False`` drops every row that has a twin.
    All forms are group-bys combined in the map tasks: a row repeated in a third
    of the table costs one row per task, not one huge group.

    ``suspects_only`` first finds out, from hashes alone, which rows can have a twin and groups only those; all others
    pass without a shuffle.  That reads the table three times and pays off for large inputs; ``None`` decides by size.
    """
    if suspects_only is None:
        suspects_only = pays_off(df)
    if not suspects_only:
        return _grouped(df, subset, keep, order_by)
    alone, others = split_repeated(df, df.columns if subset is None else require(df, subset))
    found = _grouped(others, subset, keep, order_by)
    return (as_group_keys(alone) if subset is None else alone).unionByName(found)


def _plain_zero(df: DataFrame, name: str):
    """The value as a group-by takes it: NaN is missing, minus zero is zero."""
    value = present(df, name)
    kind = type_of(df, name)
    return value + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else value


def as_group_keys(df: DataFrame) -> DataFrame:
    """The rows as a group-by of all columns would give them."""
    return df.select(*[_plain_zero(df, n).alias(n) for n in df.columns])


def pays_off(df: DataFrame) -> bool:
    """Whether so much is read that grouping suspects only is worth its scans."""
    size = input_bytes(df)
    return size is not None and size > GROUPED_BYTES


def split_repeated(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that surely have no twin on the keys, and the others.

    Hashes of the keys that occur twice are marked in a filter of ``FILTER_PLACES`` bits, which is broadcast.  A row
    whose place isn't marked is alone.  Rows that only share a place with repeated ones are among the others.
    """
    word, bit, bits = (fresh_name(df, n) for n in ("word", "bit", "bits"))
    digest = F.xxhash64(*[_plain_zero(df, n) for n in keys])
    place = F.pmod(F.col("digest"), F.lit(FILTER_PLACES))
    repeated = df.select(digest.alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    marked = repeated.groupBy(F.shiftright(place, 6).alias(word)).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(digest, {FILTER_PLACES}) % 64 AS int))")).alias(bits))
    own = F.pmod(digest, F.lit(FILTER_PLACES))
    placed = df.withColumns({word: F.shiftright(own, 6), bit: (own % 64).cast("int")}).join(F.broadcast(marked), word, "left")
    suspect = F.coalesce(F.getbit(F.col(bits), F.col(bit)) == 1, F.lit(False))
    columns = [col(n) for n in df.columns]
    return placed.where(~suspect).select(*columns), placed.where(suspect).select(*columns)


def _grouped(df: DataFrame, subset, keep, order_by) -> DataFrame:
    if keep not in ("first", "last", False):
        raise ValueError("keep must be 'first', 'last' or False")
    if subset is None:
        clean = nan_to_null(df)
        if keep is not False:
            return clean.dropDuplicates()
        count = fresh_name(df, "count")
        return (clean.groupBy(*[col(n) for n in df.columns]).agg(F.count("*").alias(count))
                .where(F.col(count) == 1).drop(count))

    keys = require(df, subset)
    key_columns = {n: f"__k{i}" for i, n in enumerate(keys)}
    whole = F.struct(*[col(n).alias(f"c{i}") for i, n in enumerate(df.columns)])
    if keep is False:
        picked = [F.first(whole).alias("row"), F.count("*").alias("n")]
    else:
        order = order_value(order_columns(df, order_by))
        edge = F.min_by if keep == "first" else F.max_by
        # never NULL itself, so a row whose order key is missing stays; it sorts last
        picked = [edge(whole, F.struct(order.isNull().alias("gap"), order.alias("at"))).alias("row"), F.lit(1).alias("n")]
    groups = df.groupBy(*[fingerprint(df, n).alias(k) for n, k in key_columns.items()]).agg(*picked)
    return groups.where(F.col("n") == 1).select(
        *[F.col(f"row.c{i}").alias(n) for i, n in enumerate(df.columns)])


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Exact duplicate rows, one kept."""
    return drop_duplicates(df)


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row, ``duplicate_rows``: how many rows repeat another one."""
    groups = df.groupBy(*[fingerprint(df, n).alias(f"k{i}") for i, n in enumerate(df.columns)]).agg(
        F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
