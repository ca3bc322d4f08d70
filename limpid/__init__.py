"""Limpid: profiling, cleaning and reshaping of tables as native Spark plans."""

from limpid.chain import Chain
from limpid.operators.aggregate import groupby_aggregate, pivot, unique_value_counts
from limpid.operators.combine import concat_with, merge_with
from limpid.operators.compare import (
    before_after, boxplot_comparison, boxplot_fliers, correlation_matrix, dtype_breakdown, histogram_comparison,
    is_plottable, missing_values_bar, snapshot,
)
from limpid.operators.dates import extract_date_parts, format_dates
from limpid.operators.dedupe import drop_duplicates, duplicate_count, remove_duplicates
from limpid.operators.encode import OneHot, apply_map, label_encode, one_hot_encode, replace_values
from limpid.operators.missing import (
    DropColumns, FillValues, drop_missing, fill_missing_bfill, fill_missing_constant, fill_missing_ffill,
    fill_missing_statistic, impute, interpolate_missing,
)
from limpid.operators.outliers import (
    Fences, ZScore, cap_outliers_iqr, detect_outliers_iqr, detect_outliers_zscore, remove_outliers_iqr,
)
from limpid.operators.profile import (
    basic_info, describe, dtypes_summary, full_report, missing_percent, missing_summary, numeric_summary,
    report_text, unique_counts,
)
from limpid.operators.profile_state import ProfileState
from limpid.operators.rank import add_rank, sample_rows, sort_values, top_n
from limpid.operators.records import CleanedRecords, RecordRules, RecordStatistics, clean_records
from limpid.operators.reshape import melt, transpose
from limpid.operators.select import (
    conditional_column, drop_columns, filter_query, math_column, parse_compare_value, rename_columns, select_columns,
)
from limpid.operators.text import change_case, replace_text, strip_whitespace
from limpid.operators.types import TypeChoice, ambiguous_dates, convert_types, to_datetime, to_numeric
from limpid.operators.validate import clip_to_range, invalidate, validate_range, validate_regex
from limpid.plans.sizing import cut_lineage
from limpid.sources.readers import (
    FILE_ORDER, read_csv, read_json, read_orc, read_parquet, read_table, read_text_table, read_xml, supports,
    with_file_order, with_row_id,
)
from limpid.sources.writers import (
    convert, write_csv, write_json, write_orc, write_parquet, write_report, write_table, write_xml,
)

__all__ = [name for name in dir() if not name.startswith("_")]
