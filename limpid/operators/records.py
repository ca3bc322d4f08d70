"""Cleaning whole records: names, categories, contacts, dates, amounts, scores.

The fields are described by :class:`RecordRules`; the job removes exact
duplicates, brings all fields into canonical form in one narrow projection,
learns every statistic it needs in one fit, and fills and caps in a second
narrow projection.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions import records as rec
from limpid.functions.columns import col, present, require
from limpid.functions.dates import is_ambiguous_date, parse_datetime
from limpid.functions.numbers import half_even_long, parse_amount, parse_double, parse_long
from limpid.functions.text import strip, title
from limpid.operators.dedupe import as_group_keys, pays_off, split_repeated
from limpid.operators.outliers import clipped
from limpid.plans.frequencies import distinct_counts
from limpid.plans.quantiles import exact_quantiles
from limpid.plans.sizing import cut_lineage

FENCE_FACTOR = 1.5


@dataclass(frozen=True)
class RecordRules:
    """What each column is.  Columns not named pass through untouched."""

    names: tuple[str, ...] = ()
    #: Rows without a value here are dropped.
    required: tuple[str, ...] = ()
    #: Trimmed and lower-cased spelling to canonical label; the rest is ``unknown``.
    categories: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    unknown: str | None = "Unknown"
    emails: tuple[str, ...] = ()
    phones: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    dayfirst: bool = False
    #: Non-negative amounts: capped at the upper fence, filled with the median, rounded.
    amounts: tuple[str, ...] = ()
    #: Amounts that only get parsed (no cap, no fill).
    plain_amounts: tuple[str, ...] = ()
    #: Whole scores with their closed range, filled with the truncated median.
    scores: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    #: Whole numbers with their closed range, invalid ones missing and left so.
    ranges: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    #: Text that starts with a count ("3 years"), with words that stand for one.
    counts: Mapping[str, Mapping[str, int]] = field(default_factory=dict)


def parsed_fields(df: DataFrame, rules: RecordRules) -> dict[str, Column]:
    """Canonical form of every named field, row by row (no statistics yet)."""
    out: dict[str, Column] = {}
    for n in rules.names:
        out[n] = title(strip(col(n)))
    for n, mapping in rules.categories.items():
        out[n] = rec.category(col(n), mapping, rules.unknown)
    for n in rules.emails:
        out[n] = rec.email(col(n))
    for n in rules.phones:
        out[n] = rec.phone(col(n))
    for n in rules.dates:
        out[n] = F.date_format(parse_datetime(col(n), dayfirst=rules.dayfirst), "yyyy-MM-dd")
    for n in (*rules.amounts, *rules.plain_amounts):
        value = parse_amount(col(n), ",₹")
        out[n] = rec.keep_if(value, value >= 0)
    for ranges in (rules.scores, rules.ranges):
        for n, (low, high) in ranges.items():
            value = parse_double(col(n))
            out[n] = rec.keep_if(value, value.between(low, high))
    for n, words in rules.counts.items():
        plain = F.lower(strip(col(n)))
        digits = parse_long(F.regexp_extract(plain, r"^(\d+)", 1))
        out[n] = F.coalesce(rec.lookup(plain, words).cast("long"), digits)
    require(df, out)
    return out


@dataclass(frozen=True)
class RecordStatistics:
    """Upper fence and median per amount, fill value per score."""

    fences: dict[str, float | None]
    medians: dict[str, float | None]

    @classmethod
    def fit(cls, parsed: DataFrame, rules: RecordRules, **options) -> RecordStatistics:
        """One fit for everything.

        The fill median of an amount is meant after capping.  Capping moves only
        values above Q3 + 1.5 IQR, and those lie above both middle ranks, so the
        median before capping is the same number.
        """
        values = {n: present(parsed, n).cast("double") for n in (*rules.amounts, *rules.scores)}
        found = exact_quantiles(parsed, values, [0.25, 0.5, 0.75], **options)
        fences = {}
        for n in rules.amounts:
            q1, _, q3 = found[n]
            fences[n] = None if q1 is None else q3 + FENCE_FACTOR * (q3 - q1)
        medians = {n: found[n][1] for n in rules.amounts}
        medians |= {n: None if found[n][1] is None else float(int(found[n][1])) for n in rules.scores}
        return cls(fences, medians)

    def finished_fields(self, df: DataFrame, rules: RecordRules) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for n in rules.amounts:
            capped = clipped(col(n), None, self.fences[n])
            out[n] = half_even_long(F.coalesce(capped, F.lit(self.medians[n]).cast("double")))
        for n in rules.plain_amounts:
            out[n] = half_even_long(col(n))
        for n in rules.scores:
            out[n] = F.coalesce(col(n), F.lit(self.medians[n]).cast("double")).cast("long")
        for n in rules.ranges:
            out[n] = col(n).cast("long")
        require(df, out)
        return out


_RAW = "__raw_"
_COPIES = "__copies"


def distinct_records(df: DataFrame, suspects_only: bool | None = None) -> DataFrame:
    """Exact duplicates folded into one row with its number of copies; of large inputs only rows that may have some are shuffled."""
    def folded(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[col(n) for n in df.columns]).agg(F.count("*").alias(_COPIES))

    if not (pays_off(df) if suspects_only is None else suspects_only):
        return folded(df)
    alone, others = split_repeated(df, df.columns)
    return as_group_keys(alone).withColumn(_COPIES, F.lit(1).cast("long")).unionByName(folded(as_group_keys(others)))


def parse_records(df: DataFrame, rules: RecordRules, *, materialize: bool = True) -> DataFrame:
    """Duplicates folded, fields parsed, raw fields kept alongside for the audit.

    ``materialize`` writes this table once to the cluster's shared folder, so the
    fit and the final pass read it back instead of repeating the shuffle.
    """
    fields = parsed_fields(df, rules)
    folded = distinct_records(df)
    parsed = folded.select(
        *[fields.get(n, col(n)).alias(n) for n in df.columns],
        *[col(n).alias(_RAW + n) for n in fields], _COPIES)
    return cut_lineage(parsed) if materialize else parsed


def clean_records(
    df: DataFrame, rules: RecordRules, *, materialize: bool = True, statistics: RecordStatistics | None = None
) -> CleanedRecords:
    """The whole job.  Pass ``statistics`` to apply values fitted on another table."""
    parsed = parse_records(df, rules, materialize=materialize)
    kept = parsed.dropna(subset=list(rules.required)) if rules.required else parsed
    statistics = statistics or RecordStatistics.fit(kept, rules)
    fields = statistics.finished_fields(kept, rules)
    table = kept.select(*[fields.get(n, col(n)).alias(n) for n in df.columns])
    return CleanedRecords(table, parsed, rules, statistics)


@dataclass(frozen=True)
class CleanedRecords:
    table: DataFrame
    parsed: DataFrame
    rules: RecordRules
    statistics: RecordStatistics

    def audit(self) -> DataFrame:
        """``(column, metric, value)`` of everything that was done: one aggregation, and counts of spellings for all categories."""
        rules = self.rules
        required = [col(n).isNotNull() for n in rules.required]
        kept = F.lit(True)
        for r in required:
            kept = kept & r
        cells: list[tuple[str | None, str, Column]] = [
            (None, "rows_in", F.sum(_COPIES)),
            (None, "duplicates_removed", F.sum(F.col(_COPIES) - 1)),
            (None, "rows_dropped", F.count_if(~kept)),
            (None, "rows_out", F.count_if(kept)),
        ]
        raw = {n: col(_RAW + n) for n in parsed_names(rules)}
        for n in rules.categories:
            # a missing label counts as one more spelling; the others are added below
            cells.append((n, "raw_labels", F.coalesce(F.max(F.when(kept & raw[n].isNull(), 1).otherwise(0)), F.lit(0))))
            gone = col(n).eqNullSafe(F.lit(rules.unknown)) if rules.unknown is not None else col(n).isNull()
            cells.append((n, "unmapped", F.count_if(kept & gone)))
        for n in (*rules.emails, *rules.phones, *rules.dates):
            cells.append((n, "missing_before", F.count_if(kept & raw[n].isNull())))
            cells.append((n, "invalid_or_missing", F.count_if(kept & col(n).isNull())))
        for n in rules.dates:
            cells.append((n, "ambiguous", F.count_if(kept & is_ambiguous_date(raw[n]))))
        for n in rules.amounts:
            number = parse_amount(raw[n], ",₹")
            fence = self.statistics.fences[n]
            cells.append((n, "negative", F.count_if(kept & (number < 0))))
            cells.append((n, "capped", F.count_if(kept & (col(n) > F.lit(fence).cast("double")))))
            cells.append((n, "imputed", F.count_if(kept & col(n).isNull())))
            cells.append((n, "upper_fence", F.max(F.lit(fence).cast("double"))))
            cells.append((n, "median", F.max(F.lit(self.statistics.medians[n]).cast("double"))))
        for n, (low, high) in rules.scores.items():
            number = parse_double(raw[n])
            cells.append((n, "out_of_range", F.count_if(kept & ~number.between(low, high))))
            cells.append((n, "imputed", F.count_if(kept & col(n).isNull())))
            cells.append((n, "median", F.max(F.lit(self.statistics.medians[n]).cast("double"))))
        wide = self.parsed.agg(*[c.cast("double").alias(f"m{i}") for i, (_, _, c) in enumerate(cells)])
        long = wide.select(F.inline(F.array(*[
            F.struct(F.lit(n).cast("string").alias("column"), F.lit(m).alias("metric"), F.col(f"m{i}").alias("value"))
            for i, (n, m, _) in enumerate(cells)])))
        if not rules.categories:
            return long
        labels = self.parsed.where(kept).select(*[raw[n].alias(n) for n in rules.categories])
        spellings = distinct_counts(labels, list(rules.categories)).select(
            "column", F.lit("raw_labels").alias("metric"), F.col("n_unique").cast("double").alias("value"))
        # every metric has one row, those of the spellings two to add up
        return long.unionByName(spellings).groupBy("column", "metric").agg(F.sum("value").alias("value"))


def parsed_names(rules: RecordRules) -> list[str]:
    return [*rules.names, *rules.categories, *rules.emails, *rules.phones, *rules.dates, *rules.amounts,
            *rules.plain_amounts, *rules.scores, *rules.ranges, *rules.counts]
