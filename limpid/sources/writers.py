"""Writing tables and reports.  Every sink is a folder written in parallel."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from limpid.sources.readers import format_of, read_table


def write_csv(df: DataFrame, path: str, *, mode: str = "error") -> None:
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_json(df: DataFrame, path: str, *, mode: str = "error") -> None:
    """JSON Lines with explicit nulls, one record per line."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def write_xml(df: DataFrame, path: str, *, mode: str = "error", row_tag: str = "row", root_tag: str = "data") -> None:
    (df.write.mode(mode).format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
     .option("nullValue", "").save(path))


def write_parquet(df: DataFrame, path: str, *, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_orc(df: DataFrame, path: str, *, mode: str = "error") -> None:
    df.write.mode(mode).orc(path)


WRITERS: dict[str, Callable[..., None]] = {
    "csv": write_csv, "json": write_json, "jsonl": write_json, "xml": write_xml,
    "parquet": write_parquet, "orc": write_orc,
}


def write_table(df: DataFrame, path: str, fmt: str | None = None, *, mode: str = "error") -> None:
    kind = (fmt or "").lower() or format_of(path)
    if kind not in WRITERS:
        raise ValueError(f"unsupported output format for {path!r}; supported: {', '.join(WRITERS)}")
    WRITERS[kind](df, path, mode=mode)


def convert(
    spark: SparkSession, src: str, targets: dict[str, str], *, src_format: str | None = None, mode: str = "error",
    **read_options,
) -> None:
    """Write one input in several formats: ``targets`` maps formats to paths."""
    if src_format in (None, "csv") and (src_format or format_of(src)) == "csv":
        read_options.setdefault("infer", False)
    df = read_table(spark, src, src_format, **read_options)
    for fmt, path in targets.items():
        write_table(df, path, fmt, mode=mode)


def write_report(report: DataFrame, audit: DataFrame, folder: str, *, mode: str = "error",
                 lines: Sequence[str] | None = None) -> None:
    """Profile and audit as tables under one folder, with the readable report beside them.

    Both are small (a few rows per column or step), so each is one file.
    """
    root = folder.rstrip("/")
    report.coalesce(1).write.mode(mode).json(f"{root}/profile")
    audit.coalesce(1).write.mode(mode).json(f"{root}/audit")
    if lines is not None:
        text = report.sparkSession.createDataFrame([(line,) for line in lines], "value string")
        text.coalesce(1).write.mode(mode).text(f"{root}/text")
