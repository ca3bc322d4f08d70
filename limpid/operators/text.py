"""Text cleaning; only text columns are touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.functions import text as tx
from limpid.functions.columns import col, resolve

Columns = str | Sequence[str] | None


def strip_whitespace(df: DataFrame, columns: Columns = None) -> DataFrame:
    """Remove whitespace of any kind at both ends."""
    names = resolve(df, columns, text=True)
    return df.withColumns({n: tx.strip(col(n)) for n in names}) if names else df


def change_case(df: DataFrame, columns: Columns = None, case: str = "lower") -> DataFrame:
    """``lower``, ``upper``, ``title`` or ``capitalize``."""
    if case not in tx.CASES:
        raise ValueError(f"case must be one of {sorted(tx.CASES)}")
    names = resolve(df, columns, text=True)
    return df.withColumns({n: tx.CASES[case](col(n)) for n in names}) if names else df


def replace_text(
    df: DataFrame, columns: Columns, pattern: str, replacement: str, regex: bool = True
) -> DataFrame:
    r"""Find and replace inside text, by regular expression (groups as ``\1``) or literally."""
    names = resolve(df, columns, text=True)
    if not names:
        return df
    if regex:
        java, into = tx.java_pattern(pattern), tx.java_replacement(replacement)
        return df.withColumns({n: F.regexp_replace(col(n), java, into) for n in names})
    return df.withColumns({n: F.replace(col(n), F.lit(pattern), F.lit(replacement)) for n in names})
