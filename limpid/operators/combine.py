"""Joining and stacking tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from limpid.functions.columns import col, is_datetime_type, is_numeric_type, is_text_type, require, type_of
from limpid.plans.joins import equi_join


def _family(data_type: T.DataType) -> str:
    if is_numeric_type(data_type):
        return "number"
    if is_text_type(data_type):
        return "text"
    if is_datetime_type(data_type):
        return "datetime"
    return data_type.simpleString()


def merge_with(
    df: DataFrame, other: DataFrame, on: str | Sequence[str], how: str = "inner", *,
    suffixes: tuple[str, str] = ("_x", "_y"), split_outer: bool | None = None,
) -> DataFrame:
    """Join on shared key columns; missing keys match each other.

    Key columns come once, from whichever side has the row; other columns that
    exist on both sides get suffixes.  ``split_outer`` forces (or forbids) the
    form of outer joins that tolerates a hot key on the side that outer joins
    cannot split; by default a key sample of large inputs decides.
    """
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError("how must be inner, left, right or outer")
    keys = require(df, on)
    require(other, on)
    for k in keys:
        a, b = type_of(df, k), type_of(other, k)
        if _family(a) != _family(b):
            raise TypeError(f"key {k!r} is {a.simpleString()} on one side and {b.simpleString()} on the other")
    output = []
    for n in df.columns:
        if n in keys:
            output.append(("key", n, n))
        else:
            output.append(("left", n, n + suffixes[0] if n in other.columns else n))
    for n in other.columns:
        if n not in keys:
            output.append(("right", n, n + suffixes[1] if n in df.columns else n))
    return equi_join(df, other, keys, how, output, split_outer=split_outer)


def concat_with(df: DataFrame, other: DataFrame, axis: int = 0, *, on: str | Sequence[str] | None = None) -> DataFrame:
    """Stack rows (``axis=0``) or paste columns (``axis=1``).

    Stacking takes the union of the columns; absent ones are missing, and a
    column whose types disagree becomes text.  Pasting needs ``on``, the row key
    that stands for the row position; rows found on one side only are kept.
    """
    if axis == 1:
        if on is None:
            raise ValueError("axis=1 needs on=<row key>: a distributed table has no row positions")
        return merge_with(df, other, on, "outer")
    if axis != 0:
        raise ValueError("axis must be 0 or 1")
    left, right = df, other
    for n in df.columns:
        if n not in other.columns:
            continue
        a, b = type_of(df, n), type_of(other, n)
        if a != b and not (is_numeric_type(a) and is_numeric_type(b)):
            left = left.withColumn(n, col(n).cast("string"))
            right = right.withColumn(n, col(n).cast("string"))
    return left.unionByName(right, allowMissingColumns=True)
