"""Wide to long and small transposes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions.columns import col, is_numeric_type, require, type_of

#: A transposed table has one column per row, so it must be small.
MAX_TRANSPOSE_ROWS = 500


def melt(
    df: DataFrame, id_vars: str | Sequence[str], value_vars: str | Sequence[str] | None = None, *,
    var_name: str = "variable", value_name: str = "value",
) -> DataFrame:
    """Fold columns into ``variable`` and ``value`` rows, missing cells included.

    Columns of one type keep it, numbers of several types meet in double,
    anything else becomes text.
    """
    ids = require(df, id_vars)
    folded = require(df, value_vars) if value_vars is not None else [n for n in df.columns if n not in ids]
    both = [n for n in folded if n in ids]
    if both:
        raise ValueError(f"{both} cannot be identifiers and values at once")
    types = {type_of(df, n).simpleString() for n in folded}
    if len(types) > 1:
        common = "double" if all(is_numeric_type(type_of(df, n)) for n in folded) else "string"
        df = df.select(*[col(n) for n in ids], *[col(n).cast(common).alias(n) for n in folded])
    return df.unpivot([col(n) for n in ids], [col(n) for n in folded], var_name, value_name)


def transpose(df: DataFrame, index_column: str, *, max_rows: int = MAX_TRANSPOSE_ROWS) -> DataFrame:
    """Flip a small result: column ``index`` with the old column names, one column per row.

    The new columns are named by ``index_column``.  More than ``max_rows`` rows is an error, and so are values of
    it that are missing or occur twice, which could not name one column each.
    """
    require(df, index_column)
    names = [r[0] for r in df.select(col(index_column).cast("string")).limit(max_rows + 1).collect()]
    if len(names) > max_rows:
        raise ValueError(f"transpose is for small results: more than {max_rows} rows")
    if None in names or len(set(names)) < len(names):
        raise ValueError(f"column {index_column!r} must have a different value in every row to name the new columns")
    others = [n for n in df.columns if n != index_column]
    long = melt(df.select(col(index_column), *[col(n).cast("string").alias(n) for n in others]),
                index_column, others, var_name="index", value_name="__cell")
    return long.groupBy("index").pivot(index_column, sorted(names)).agg(F.first("__cell"))
