"""Category encodings, dictionary lookups and whole-cell replacement."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    col, fresh_name, is_missing, is_numeric_type, is_text_type, present, require, type_of,
)
from limpid.functions.records import lookup
from limpid.plans.fitting import fitted, planned
from limpid.plans.frequencies import distinct_values
from limpid.plans.ordering import order_columns, order_value, with_position
from limpid.plans.sizing import MB, cut_lineage

#: Up to this many distinct values (and bytes) one task numbers them and the table is broadcast.
SMALL_DICTIONARY = 100_000
SMALL_DICTIONARY_BYTES = 32 * MB
#: A longer mapping becomes a joined table instead of a literal.
LITERAL_MAPPING = 1000


@dataclass(frozen=True)
class OneHot:
    """Sorted values per column; ``apply`` adds one 0/1 column per value."""

    values: dict[str, tuple]

    @classmethod
    @fitted
    def fit(cls, df: DataFrame, columns: str | Sequence[str], max_values: int = 1000) -> OneHot:
        found = distinct_values(df, require(df, columns), max_values)
        return cls({n: tuple(values) for n, values in found.items()})

    def apply(self, df: DataFrame) -> DataFrame:
        kept = [col(n) for n in df.columns if n not in self.values]
        added = [
            F.coalesce(col(n) == F.lit(v), F.lit(False)).cast("int").alias(f"{n}_{v}")
            for n, values in self.values.items() for v in values]
        return df.select(*kept, *added)


def one_hot_encode(df: DataFrame, columns: str | Sequence[str], *, max_values: int = 1000) -> DataFrame:
    """Replace each column by 0/1 columns ``{column}_{value}`` at the end; missing is all zeros."""
    return OneHot.fit(df, columns, max_values).apply(df)


def label_encode(
    df: DataFrame, columns: str | Sequence[str], *, order_by: str | Sequence[str], small: int = SMALL_DICTIONARY
) -> DataFrame:
    """Replace categories by codes in order of first appearance; missing is -1.

    Applied again by a chain, the codes are those of the table it was fitted on; a value unknown there is -1.
    """
    keys = order_columns(df, order_by)
    names = require(df, columns)
    out = df
    for i, n in enumerate(names):
        value, code = fresh_name(out, f"value{i}"), fresh_name(out, f"code{i}")
        codes = first_seen_codes(df, n, keys, small=small).toDF(value, code)
        if codes.schema[value].dataType != type_of(df, n):
            raise TypeError(f"column {n!r} has another type than where its codes were fitted")
        out = out.join(codes, present(df, n) == F.col(value), "left").drop(value)
        out = out.withColumn(code, F.coalesce(F.col(code), F.lit(-1).cast("long")))
    coded = {n: fresh_name(df, f"code{i}") for i, n in enumerate(names)}
    return out.select(*[F.col(coded[n]).alias(n) if n in coded else col(n) for n in df.columns])


@planned
def _is_small(df: DataFrame, value: str, rows: int) -> bool:
    """Whether the table holds at most that many rows and its values take little room."""
    size = F.sum(F.octet_length(F.col(value).cast("string")))
    found = df.limit(rows + 1).agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    return found["rows"] <= rows and (found["bytes"] or 0) <= SMALL_DICTIONARY_BYTES


@fitted
def first_seen_codes(df: DataFrame, column: str, keys: list[str], *, small: int) -> DataFrame:
    """``(value, code)`` for every value that is there, numbered by first appearance from 0.

    The dictionary is written to the shared folder if there is one, so applying it again reads it back.
    """
    value, code = "value", "code"
    seen = (
        df.select(present(df, column).alias(value), order_value(keys).alias("first"))
        .where(F.col(value).isNotNull()).groupBy(value).agg(F.min("first").alias("first")))
    if len(keys) == 1:
        flat = seen.select(value, F.col("first").alias("f0"))
    else:
        flat = seen.select(value, *[F.col("first")[k].alias(f"f{i}") for i, k in enumerate(keys)])
    firsts = [c for c in flat.columns if c != value]
    if _is_small(flat, value, small):
        # the bounds were just checked: one bucket is enough and the table may be broadcast
        return F.broadcast(cut_lineage(with_position(flat, firsts, code, buckets=1).select(
            value, (F.col(code) - 1).alias(code))))
    # numbering reads the dictionary several times, so it is written once
    return cut_lineage(with_position(cut_lineage(flat), firsts, code).select(value, (F.col(code) - 1).alias(code)))


def apply_map(
    df: DataFrame, column: str, mapping: Mapping | DataFrame, new_column: str | None = None
) -> DataFrame:
    """Translate values; what the mapping does not know becomes missing.

    A mapping too large for a literal comes as a two-column DataFrame
    ``(key, value)`` and is joined; Catalyst broadcasts it when its size allows.
    A key that occurs twice is an error, since it would repeat rows.
    """
    require(df, column)
    target = new_column or column
    if isinstance(mapping, Mapping) and len(mapping) > LITERAL_MAPPING:
        mapping = df.sparkSession.createDataFrame(list(mapping.items()), ["key", "value"])
    if isinstance(mapping, DataFrame):
        key, value = fresh_name(df, "key"), fresh_name(df, "mapped")
        pairs = mapping.toDF(key, value).where(F.col(key).isNotNull())
        if pairs.groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError("a key of the mapping occurs more than once")
        joined = df.join(pairs, present(df, column) == F.col(key), "left").drop(key)
        return joined.withColumn(target, F.col(value)).drop(value)
    return df.withColumn(target, lookup(col(column), mapping))


def _replaceable(data_type: T.DataType, old: object) -> bool:
    if isinstance(old, bool):
        return isinstance(data_type, T.BooleanType)
    if isinstance(old, (int, float)):
        return is_numeric_type(data_type)
    if isinstance(old, str):
        return is_text_type(data_type)
    return False


def _is_gap(value: object) -> bool:
    return value is None or (isinstance(value, float) and math.isnan(value))


def _new_value(data_type: T.DataType, new: object) -> Column | None:
    """The new value as a literal; ``None`` when the column's type cannot hold it."""
    if _is_gap(new):
        return F.lit(None).cast(data_type)
    number = isinstance(new, (int, float)) and not isinstance(new, bool)
    if is_numeric_type(data_type) and number:
        if isinstance(data_type, T.IntegralType) and not float(new).is_integer():
            return F.lit(float(new))
        return F.lit(new).cast(data_type)
    if is_text_type(data_type):
        return F.lit(str(new))
    if isinstance(data_type, T.BooleanType) and isinstance(new, bool):
        return F.lit(new)
    return None


def replace_values(df: DataFrame, to_replace: object, value: object) -> DataFrame:
    """Replace a whole-cell value in every column of its type; either side may be missing.

    Replacing missing cells fills the columns that can hold the new value.
    """
    out = {}
    for n in df.columns:
        data_type = type_of(df, n)
        if _is_gap(to_replace):
            new = _new_value(data_type, value)
            if new is not None and not _is_gap(value) and not (is_text_type(data_type) and not isinstance(value, str)):
                out[n] = F.when(is_missing(df, n), new).otherwise(col(n))
        elif _replaceable(data_type, to_replace):
            new = _new_value(data_type, value)
            if new is None:
                raise TypeError(f"column {n!r} ({data_type.simpleString()}) cannot hold {value!r}")
            out[n] = F.when(col(n) == F.lit(to_replace), new).otherwise(col(n))
    return df.withColumns(out) if out else df
