"""Type conversion."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import (
    as_number, col, is_datetime_type, is_numeric_type, is_text_type, present, resolve, type_of,
)
from limpid.functions.dates import is_ambiguous_date, parse_datetime
from limpid.functions.numbers import parse_double, parse_long
from limpid.plans.fitting import fitted

Columns = str | Sequence[str] | None


@dataclass(frozen=True)
class TypeChoice:
    """The type chosen per column; ``apply`` casts."""

    types: dict[str, str]

    @classmethod
    @fitted
    def fit(cls, df: DataFrame, columns: Columns = None, *, infer_text: bool = False) -> TypeChoice:
        """One aggregation over all candidate columns.

        Whole-numbered floating columns become long.  With ``infer_text``, text
        becomes long, double or boolean when no value is lost.
        """
        names = resolve(df, columns)
        tests: dict[tuple[str, str], Column] = {}
        for n in names:
            data_type = type_of(df, n)
            if isinstance(data_type, (T.FloatType, T.DoubleType)):
                v = present(df, n)
                # beyond 2**53 a double is no longer a reliable whole number
                tests[n, "long"] = v.isNull() | ((v == F.floor(v).cast("double")) & (F.abs(v) <= 2.0 ** 53))
            elif infer_text and is_text_type(data_type):
                c = F.trim(col(n))
                blank = col(n).isNull()
                tests[n, "long"] = blank | parse_long(c).isNotNull()
                tests[n, "double"] = blank | parse_double(c).isNotNull() | (F.lower(c) == "nan")
                tests[n, "boolean"] = blank | F.lower(c).isin("true", "false")
        if not tests:
            return cls({})
        row = df.agg(
            *[F.count_if(~F.coalesce(t, F.lit(False))).alias(f"bad{i}") for i, t in enumerate(tests.values())],
            *[F.count(col(n)).alias(f"n{i}") for i, n in enumerate(names)]).first()
        filled = {n: row[f"n{i}"] for i, n in enumerate(names)}
        chosen: dict[str, str] = {}
        for i, (n, candidate) in enumerate(tests):
            if n not in chosen and row[f"bad{i}"] == 0 and filled[n]:
                chosen[n] = candidate
        return cls(chosen)

    def apply(self, df: DataFrame) -> DataFrame:
        out = {}
        for n, target in self.types.items():
            if is_text_type(type_of(df, n)):
                c = F.trim(col(n))
                out[n] = {"long": parse_long, "double": parse_double}.get(target, lambda x: x.try_cast("boolean"))(c)
            else:
                out[n] = present(df, n).cast(target)
        return df.withColumns(out) if out else df


def convert_types(df: DataFrame, *, infer_text: bool = False) -> DataFrame:
    """Give every column the narrowest fitting type; text only when ``infer_text``."""
    return TypeChoice.fit(df, infer_text=infer_text).apply(df)


def to_numeric(df: DataFrame, columns: Columns = None, errors: str = "coerce") -> DataFrame:
    """Text to double.  ``coerce`` turns what does not parse into missing, ``raise`` fails the job."""
    if errors not in ("coerce", "raise"):
        raise ValueError("errors must be 'coerce' or 'raise'")
    out = {}
    for n in resolve(df, columns):
        data_type = type_of(df, n)
        if is_numeric_type(data_type) or isinstance(data_type, T.BooleanType):
            continue
        number = as_number(df, n)
        if errors == "raise" and is_text_type(data_type):
            message = F.concat(F.lit(f"column {n}: cannot read as a number: "), col(n))
            number = F.when(col(n).isNotNull() & number.isNull() & (F.lower(F.trim(col(n))) != "nan"),
                            F.raise_error(message).cast("double")).otherwise(number)
        out[n] = number
    return df.withColumns(out) if out else df


def to_datetime(df: DataFrame, columns: Columns = None, *, dayfirst: bool = False) -> DataFrame:
    """Mixed-format text to timestamp; garbage becomes missing, ambiguous dates are month first."""
    out = {}
    for n in resolve(df, columns):
        data_type = type_of(df, n)
        if is_text_type(data_type):
            out[n] = parse_datetime(col(n), dayfirst=dayfirst)
        elif is_datetime_type(data_type):
            out[n] = col(n).cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def ambiguous_dates(df: DataFrame, columns: Columns) -> DataFrame:
    """``(column, ambiguous_count)``: values whose day and month could be swapped."""
    names = resolve(df, columns, text=True)
    wide = df.agg(*[F.count_if(is_ambiguous_date(col(n))).alias(n) for n in names])
    return wide.unpivot([], [col(n) for n in names], "column", "ambiguous_count")
