"""Applying a fitted chain to a stream of files.

Row-wise steps and steps with learned values are narrow projections and
filters, which Structured Streaming runs as they are.  Steps that need the
whole table (sorting, carrying values between rows, ranking) are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from limpid.chain import Chain

NARROW = frozenset({
    "drop_missing", "fill_missing_constant", "fill_missing_statistic", "convert_types", "to_numeric", "to_datetime",
    "strip_whitespace", "change_case", "replace_text", "cap_outliers_iqr", "remove_outliers_iqr", "clip_to_range",
    "invalidate", "filter_query", "select_columns", "drop_columns", "rename_columns", "conditional_column",
    "math_column", "melt", "apply_map", "replace_values", "one_hot_encode", "extract_date_parts", "format_dates",
})


def clean_stream(chain: Chain, stream: DataFrame) -> DataFrame:
    """The chain's steps on a streaming table, with the values learned on the batch table."""
    wide = [s.operator for s in chain.steps if s.operator not in NARROW]
    if wide:
        raise ValueError(f"these steps need the whole table and cannot run on a stream: {wide}")
    return chain.apply_to(stream)


def write_stream(table: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append the cleaned rows to a folder, exactly once, taking the files that are there and stopping.

    ``checkpoint`` must lie in storage that all executors share.
    """
    return (table.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
