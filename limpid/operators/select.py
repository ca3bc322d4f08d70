"""Columns and rows: select, drop, rename, filter, derive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    col, is_numeric_type, is_text_type, present, require, type_of,
)


def select_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Keep the listed columns, in that order; unknown names raise."""
    return df.select(*[col(n) for n in require(df, columns)])


def drop_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop the listed columns; unknown names raise."""
    gone = set(require(df, columns))
    return df.select(*[col(n) for n in df.columns if n not in gone])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; other columns keep their names, unknown keys are ignored."""
    return df.select(*[col(n).alias(mapping.get(n, n)) for n in df.columns])


def filter_query(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep the rows for which a boolean SQL expression (or column) is true.

    Names with blanks go in backticks.  As in SQL, a comparison with a missing
    value is not true; to keep missing rows under "differs from x" write
    ``NOT (c <=> x)``.
    """
    return df.where(condition)


def parse_compare_value(text: str) -> float | str:
    """A typed compare value from user text: a number when it reads as one."""
    try:
        return float(text)
    except ValueError:
        return text


_COMPARE = {
    ">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b, "==": lambda a, b: a == b,
}


def compare(df: DataFrame, name: str, op: str, value: object) -> Column:
    """``column op value`` where a missing cell is never true, except for ``!=``."""
    if op not in _COMPARE and op != "!=":
        raise ValueError(f"op must be one of {[*_COMPARE, '!=']}")
    require(df, name)
    data_type = type_of(df, name)
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    comparable = not ((is_text_type(data_type) and number) or (is_numeric_type(data_type) and isinstance(value, str)))
    if not comparable:
        if op in ("==", "!="):
            return F.lit(op == "!=")
        raise TypeError(f"cannot compare {data_type.simpleString()} column {name!r} with {value!r}")
    cell = present(df, name)
    literal = F.lit(value) if isinstance(value, (int, float, str, bool)) else F.lit(str(value)).cast(data_type)
    if op == "!=":
        return ~cell.eqNullSafe(literal)
    return F.coalesce(_COMPARE[op](cell, literal), F.lit(False))


def conditional_column(
    df: DataFrame, new_column: str, condition_column: str, op: str, compare_value: object,
    true_value: object, false_value: object,
) -> DataFrame:
    """New column: one value where the comparison holds, another where not.

    Both values get one common type; a number next to text becomes text.
    """
    if isinstance(true_value, str) != isinstance(false_value, str):
        true_value, false_value = str(true_value), str(false_value)
    test = compare(df, condition_column, op, compare_value)
    return df.withColumn(new_column, F.when(test, F.lit(true_value)).otherwise(F.lit(false_value)))


def math_column(
    df: DataFrame, new_column: str, column: str, operation: str, other: str | float, *, div0: str = "null"
) -> DataFrame:
    """Column arithmetic with a second column or a number.

    ``other`` is a column when the table has that name.  Division is always true
    division; by zero it gives missing, or signed infinity and NaN under
    ``div0="ieee"``.  ``+`` on text joins the texts.
    """
    if operation not in ("+", "-", "*", "/"):
        raise ValueError("operation must be one of + - * /")
    if div0 not in ("null", "ieee"):
        raise ValueError("div0 must be 'null' or 'ieee'")
    require(df, column)
    left_type = type_of(df, column)
    if isinstance(other, str) and other in df.columns:
        right, right_text = present(df, other), is_text_type(type_of(df, other))
        whole = isinstance(left_type, T.IntegralType) and isinstance(type_of(df, other), T.IntegralType)
    else:
        right, right_text = F.lit(other), isinstance(other, str)
        whole = isinstance(left_type, T.IntegralType) and isinstance(other, int)
    left = present(df, column)
    if is_text_type(left_type) != right_text:
        raise TypeError(f"cannot combine {column!r} ({left_type.simpleString()}) with {other!r}")
    if right_text:
        if operation != "+":
            raise TypeError("text columns support only '+'")
        return df.withColumn(new_column, F.concat(left, right))
    if operation == "/":
        a, b = left.cast("double"), right.cast("double")
        value = F.try_divide(a, b)
        if div0 == "ieee":
            at_zero = F.when(a > 0, float("inf")).when(a < 0, float("-inf")).when(a == 0, float("nan"))
            value = F.when(b == 0, at_zero).otherwise(value)
        return df.withColumn(new_column, value)
    kind = "long" if whole else "double"
    a, b = left.cast(kind), right.cast(kind)
    value = {"+": a + b, "-": a - b, "*": a * b}[operation]
    return df.withColumn(new_column, value)
