"""Operators in a row, with an audit of every step.

    chain = (Chain(df, order_by="id")
             .drop_duplicates()
             .strip_whitespace()
             .cap_outliers_iqr(["price"]))
    chain.run(lambda table: write_table(table, path))
    chain.audit().show()

Nothing runs until a step has to learn a value or the table is written.  What
the steps learned is remembered, so the same cleaning can be applied to another
table with :meth:`Chain.apply_to` without fitting again.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from limpid.functions.columns import is_missing
from limpid.operators import (
    aggregate, combine, compare, dates, dedupe, encode, missing, outliers, profile, rank, reshape, select, text,
    types, validate,
)
from limpid.plans.fitting import recording, replaying

#: Operators that give the next table of the chain.
STEPS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (
    missing.drop_missing, missing.fill_missing_constant, missing.fill_missing_statistic, missing.fill_missing_ffill,
    missing.fill_missing_bfill, missing.interpolate_missing, missing.impute,
    dedupe.drop_duplicates, types.convert_types, types.to_numeric, types.to_datetime,
    text.strip_whitespace, text.change_case, text.replace_text,
    outliers.cap_outliers_iqr, outliers.remove_outliers_iqr, validate.clip_to_range, validate.invalidate,
    select.filter_query, rank.top_n, rank.sample_rows, rank.sort_values, rank.add_rank,
    select.select_columns, select.drop_columns, select.rename_columns, select.conditional_column, select.math_column,
    reshape.melt, reshape.transpose, aggregate.pivot, aggregate.groupby_aggregate,
    combine.merge_with, combine.concat_with, encode.apply_map, encode.replace_values,
    encode.one_hot_encode, encode.label_encode, dates.extract_date_parts, dates.format_dates,
)}

#: Operators that answer a question about the current table and leave it as it is.
INSPECTIONS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (
    outliers.detect_outliers_iqr, outliers.detect_outliers_zscore, validate.validate_regex, validate.validate_range,
    aggregate.unique_value_counts, types.ambiguous_dates,
    profile.basic_info, profile.dtypes_summary, profile.missing_summary, profile.missing_percent,
    dedupe.duplicate_count, profile.unique_counts, profile.numeric_summary, profile.describe, profile.full_report,
    compare.dtype_breakdown, compare.correlation_matrix, compare.missing_values_bar, compare.is_plottable,
    compare.boxplot_fliers,
)}

_AUDIT = ("step int, operator string, params string, rows_before bigint, rows_after bigint, "
          "missing_before bigint, missing_after bigint")


@dataclass(frozen=True)
class Step:
    operator: str
    args: tuple
    kwargs: dict
    learned: dict

    def params(self) -> str:
        shown = [_shown(a) for a in self.args]
        named = {k: _shown(v) for k, v in self.kwargs.items()}
        return json.dumps({"args": shown, **named}, default=str, ensure_ascii=False)

    def apply(self, df: DataFrame, *, same_table: bool = False) -> DataFrame:
        with replaying(self.learned, same_table=same_table):
            return STEPS[self.operator](df, *self.args, **self.kwargs)


def _shown(value: object) -> object:
    return f"table{value.columns}" if isinstance(value, DataFrame) else value


class Chain:
    """A table, the steps that led to it and what they learned.  Immutable: a step gives a new chain."""

    def __init__(self, df: DataFrame, order_by: str | Sequence[str] | None = None,
                 _origin: DataFrame | None = None, _steps: tuple[Step, ...] = ()):
        self.df = df
        self.order_by = order_by
        self.origin = _origin if _origin is not None else df
        self.steps = _steps
        self._observations: list[Observation] | None = None

    def __getattr__(self, name: str):
        if name in STEPS:
            return lambda *args, **kwargs: self._step(name, args, kwargs)
        if name in INSPECTIONS:
            return lambda *args, **kwargs: INSPECTIONS[name](self.df, *args, **kwargs)
        raise AttributeError(name)

    def __dir__(self):
        return [*super().__dir__(), *STEPS, *INSPECTIONS]

    def _step(self, name: str, args: tuple, kwargs: dict) -> Chain:
        accepted = inspect.signature(STEPS[name]).parameters
        if "order_by" in accepted and "order_by" not in kwargs and self.order_by is not None:
            kwargs = {**kwargs, "order_by": self.order_by}
        with recording() as memo:
            df = STEPS[name](self.df, *args, **kwargs)
        step = Step(name, args, kwargs, memo.values)
        return Chain(df, self.order_by, self.origin, (*self.steps, step))

    def apply_to(self, df: DataFrame) -> DataFrame:
        """The same steps on another table, with the values learned on this one.

        Sizes, hot keys, split points and row checks are looked at anew.
        """
        for step in self.steps:
            df = step.apply(df)
        return df

    def log(self) -> list[str]:
        """One line per step, in order."""
        return [f"{i}. {s.operator} {s.params()}" for i, s in enumerate(self.steps, 1)]

    def run(self, action: Callable[[DataFrame], object]) -> object:
        """Run an action that consumes the whole table; row and gap counts ride along on its job.

        The counts are taken between the steps by observations.  They keep
        filters from moving below them, which is the price of counting in the
        same pass; use ``chain.df`` for a plain plan.
        """
        observations = [Observation()]
        df = _observed(self.origin, observations[0])
        for step in self.steps:
            observations.append(Observation())
            df = _observed(step.apply(df, same_table=True), observations[-1])
        result = action(df)
        self._observations = observations
        return result

    def audit(self) -> DataFrame:
        """One row per step; counts are there once :meth:`run` has been used."""
        seen = [o.get for o in self._observations] if self._observations else None
        rows = []
        for i, s in enumerate(self.steps, 1):
            before, after = (seen[i - 1], seen[i]) if seen else ({}, {})
            rows.append((i, s.operator, s.params(), before.get("rows"), after.get("rows"),
                         before.get("missing"), after.get("missing")))
        return self.origin.sparkSession.createDataFrame(rows, _AUDIT)


def _observed(df: DataFrame, observation: Observation) -> DataFrame:
    gaps = F.lit(0)
    for n in df.columns:
        gaps = gaps + F.count_if(is_missing(df, n))
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), gaps.alias("missing"))
