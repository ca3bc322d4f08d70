"""Reading tables: CSV, JSON, XML, Parquet and ORC.

Text formats are read as text, missing markers are turned into NULL, and the
types are then chosen by one aggregation over the columns (or given by a
schema, which costs no job and is the way to read large text inputs).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import col, is_text_type, type_of
from limpid.functions.numbers import parse_double, parse_long
from limpid.operators.types import TypeChoice
from limpid.sources.split_records import split_csv, split_json

# The texts a data file uses for "no value", compared to the whole cell.
PANDAS_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: The order key that :func:`with_file_order` and split reading add.
FILE_ORDER = ("_file_path", "_file_block", "_row_id")

Schema = str | T.StructType | None


def _null_markers(df: DataFrame, missing_markers: str | Sequence[str] | None) -> DataFrame:
    """``"pandas"``: the usual markers; ``"blank"``: only blank cells; or a list of markers."""
    if missing_markers is None:
        return df

    def is_gap(c: Column) -> Column:
        if missing_markers == "blank":
            return c.rlike(r"(?U)^\s*$")
        markers = PANDAS_MARKERS if missing_markers == "pandas" else tuple(missing_markers)
        return c.isin(*markers)

    names = [n for n in df.columns if is_text_type(type_of(df, n))]
    return df.withColumns({n: F.when(~is_gap(col(n)), col(n)) for n in names}) if names else df


def _cell(df: DataFrame, field: T.StructField) -> Column:
    """The cell in the wanted type; text that does not fit is missing."""
    value = col(field.name)
    if is_text_type(type_of(df, field.name)):
        if isinstance(field.dataType, T.IntegralType):
            value = parse_long(value)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = parse_double(value)
    return value.try_cast(field.dataType)


def _typed(df: DataFrame, schema: Schema, infer: bool, places: Sequence[str] = ()) -> DataFrame:
    """The wanted or the fitting types; ``places`` are columns of the reader's own, which stay as they are."""
    if schema is not None:
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return df.select(*[_cell(df, f).alias(f.name) for f in wanted], *[col(p) for p in places])
    return TypeChoice.fit(df, [n for n in df.columns if n not in places], infer_text=True).apply(df) if infer else df


def read_csv(
    spark: SparkSession, path, *, schema: Schema = None, infer: bool = True,
    missing_markers: str | Sequence[str] | None = "pandas", multiline: bool = True, split: bool = False,
    file_order: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes.

    ``multiline`` accepts line breaks inside quotes, which keeps a file in one task; turn it off to split large
    files that have none.  ``split`` reads large files that do have line breaks in quotes by many tasks, for two
    scans and a shuffle; quotes then only stand around cells and doubled inside them, as writers put them, and line
    breaks in cells stay as they are.  As its rows come in no order, ``file_order`` adds the columns ``FILE_ORDER``.
    """
    if file_order and not split:
        raise ValueError("file_order goes with split; other readings take with_file_order")
    places = FILE_ORDER if file_order else ()
    options = {"escape": '"', "nullValue": "", "mode": "PERMISSIVE"}
    if split:
        text = split_csv(spark, path, options, places)
    else:
        text = spark.read.csv(path, header=True, multiLine=multiline, inferSchema=False, **options)
    return _typed(_null_markers(text, missing_markers), schema, infer, places)


def read_text_table(spark: SparkSession, path, *, multiline: bool = True, split: bool = False) -> DataFrame:
    """CSV with every column as text and only blank cells missing."""
    return read_csv(spark, path, infer=False, missing_markers="blank", multiline=multiline, split=split)


def read_json(
    spark: SparkSession, path, *, schema: Schema = None, infer: bool = True,
    missing_markers: str | Sequence[str] | None = None, lines: bool = False, columns: Sequence[str] | None = None,
    split: bool = False, file_order: bool = False,
) -> DataFrame:
    """An array of records, or JSON Lines with ``lines``.

    Columns come in alphabetical order unless ``schema`` or ``columns`` gives
    one.  Text columns that hold only numbers become numbers, as for CSV.
    ``split`` reads a large array by many tasks, for some scans and a shuffle; it needs ``schema`` or ``columns``.
    As its rows come in no order, ``file_order`` adds the columns ``FILE_ORDER``.
    """
    if file_order and not split:
        raise ValueError("file_order goes with split; other readings take with_file_order")
    places = FILE_ORDER if file_order else ()
    reader = spark.read.option("multiLine", not lines)
    if columns is None and schema is not None:
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        columns = wanted.names
    if columns is not None:
        # a primitive of any kind reads as text, so no inference pass is needed
        fields = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        raw = split_json(spark, path, fields, places) if split else reader.schema(fields).json(path)
    elif split:
        raise ValueError("split reading needs a schema or the columns")
    else:
        raw = reader.option("primitivesAsString", schema is not None).json(path)
    return _typed(_null_markers(raw, missing_markers), schema, infer, places)


def read_xml(
    spark: SparkSession, path, *, schema: Schema = None, infer: bool = True, row_tag: str = "row",
    missing_markers: str | Sequence[str] | None = "pandas", columns: Sequence[str] | None = None,
) -> DataFrame:
    """Flat XML, one element per row; empty elements are missing."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("nullValue", "")
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    else:
        reader = reader.option("inferSchema", False)
    return _typed(_null_markers(reader.load(path), missing_markers), schema, infer)


def read_parquet(spark: SparkSession, path, *, schema: Schema = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)


def read_orc(spark: SparkSession, path, *, schema: Schema = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.orc(path)


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv, "json": read_json, "jsonl": lambda spark, path, **o: read_json(spark, path, lines=True, **o),
    "xml": read_xml, "parquet": read_parquet, "orc": read_orc,
}


def format_of(path: str) -> str | None:
    """The format named by the extension, in any letter case; ``None`` when it is unknown."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower().lstrip(".")
    return suffix if suffix in READERS else None


def supports(path: str) -> bool:
    return format_of(path) is not None


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read by extension, or by ``fmt`` for folders and globs without one."""
    kind = (fmt or "").lower() or format_of(path)
    if kind not in READERS:
        suffix = PurePosixPath(path).suffix
        raise ValueError(f"unsupported file type {suffix!r}; supported: " + ", ".join(f".{k}" for k in READERS))
    return READERS[kind](spark, path, **options)


def with_row_id(df: DataFrame, name: str = "_row_id") -> DataFrame:
    """Add the file order as an order key to a table fresh from its files.

    Apply it directly to what a reader returns: above a shuffle the order of the
    rows means nothing.  Ids follow the order of the scan's tasks, which is the
    file order for one file; for several files see :func:`with_file_order`.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def with_file_order(df: DataFrame) -> DataFrame:
    """Add path, block and row id: together the order of rows from several files.

    Pass ``order_by=list(FILE_ORDER)`` to the operators that depend on row order.
    """
    return df.select(
        "*", F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_file_block"), F.monotonically_increasing_id().alias("_row_id"))
