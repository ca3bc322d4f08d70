"""Records that span lines, read by as many tasks as a file has splits.

A file is read in pieces (lines of CSV, texts up to a closing brace of JSON), and the splits of the scan are its
chunks.  Whether a piece begins a record depends on all pieces before it: on whether a quote is open, on how many
braces are.  Both are sums, so one row per chunk, summed up in file order, and a window inside each chunk say it
exactly.  What of a record lies in later chunks than its beginning is put behind it; that is at most one fragment
per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.columns import col
from limpid.plans.sizing import cut_lineage

CHUNK = ["file", "block"]
#: Order of the records: file, chunk and number in it.
PLACE = ["file", "block", "number"]


def _pieces(spark: SparkSession, path, separator: str) -> DataFrame:
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"), F.col("value").alias("text"))


def _count(text: Column, letter: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))).cast("long")


def _sum_before(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier pieces of the file."""
    chunks = pieces.groupBy(*CHUNK).agg(F.sum(value).alias("own"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*CHUNK, F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy(*CHUNK).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.join(chunks, CHUNK).withColumn(
        name, F.col("earlier") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("earlier")


def _records(pieces: DataFrame, begins: Column, separator: str) -> DataFrame:
    """``file``, ``block``, ``number`` and ``text`` of the records, put together from pieces; ``begins`` marks their first ones."""
    running = Window.partitionBy(*CHUNK).orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.sum(begins.cast("long")).over(running))
    in_order = F.array_sort(F.collect_list(F.struct("piece", "text")))
    fragments = cut_lineage(numbered.groupBy(*PLACE).agg(
        F.array_join(F.transform(in_order, lambda p: p["text"]), separator).alias("text")))
    # number 0 is what a chunk holds of a record that began in an earlier one
    ends = fragments.groupBy(*CHUNK).agg(F.max("number").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("last") > 0, F.struct("block", "last")), ignorenulls=True).over(earlier)
    owners = ends.select(*CHUNK, owner.alias("owner")).where("owner IS NOT NULL")
    rests = fragments.where("number = 0").join(owners, CHUNK).groupBy(
        "file", F.col("owner.block").alias("of_block"), F.col("owner.last").alias("of_number")).agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("rests"))
    rests = rests.withColumnRenamed("file", "of_file")
    same = [F.col(a) == F.col(b) for a, b in zip(PLACE, ("of_file", "of_block", "of_number"))]
    whole = F.concat(F.array(F.col("text")), F.coalesce(F.transform("rests", lambda r: r["text"]), F.array().cast("array<string>")))
    return fragments.where("number > 0").join(rests, same[0] & same[1] & same[2], "left").select(
        *PLACE, F.array_join(whole, separator).alias("text"))


def csv_records(spark: SparkSession, path) -> DataFrame:
    """Records of CSV files whose quotes stand only around cells and doubled inside them, header lines included."""
    lines = _sum_before(_pieces(spark, path, "\n"), _count(F.col("text"), '"'), "quotes")
    return _records(lines, F.col("quotes") % 2 == 0, "\n")


def split_csv(spark: SparkSession, path, options: dict[str, str], order: Sequence[str] = ()) -> DataFrame:
    """All cells as text, named by the header of the first file; ``order`` names columns for file, block and number."""
    names = spark.read.csv(path, header=True, multiLine=True, inferSchema=False, **options).columns
    records = csv_records(spark, path).where("NOT (block = 0 AND number = 1)")
    text = F.regexp_replace("text", r"\r$", "")
    schema = ", ".join(f"c{n} string" for n in range(len(names)))
    cells = records.where(F.length(text) > 0).select(
        *PLACE, F.from_csv(text, schema, {**options, "multiLine": "true"}).alias("cells"))
    return cells.select(*[F.col(f"cells.c{n}").alias(name) for n, name in enumerate(names)], *_places(order))


def json_records(spark: SparkSession, path) -> DataFrame:
    """Records (objects) of JSON files that hold an array of them, on one line or many."""
    pieces = _pieces(spark, path, "}").withColumn("bare", F.regexp_replace("text", r"(?s)\\.", ""))
    pieces = _sum_before(pieces, _count(F.col("bare"), '"'), "quotes")
    within = F.col("quotes") % 2 == 1
    still = (F.col("quotes") + _count(F.col("bare"), '"')) % 2 == 1
    outside = F.regexp_replace(F.when(within, F.regexp_replace("bare", r'^[^"]*"?', "")).otherwise(F.col("bare")), r'"[^"]*(?:"|$)', "")
    # a piece ends with a brace, which closes an object unless it lies in a string
    pieces = pieces.withColumn("opened", _count(outside, "{") - F.when(still, 0).otherwise(1)).drop("bare")
    pieces = _sum_before(pieces, F.col("opened"), "open").drop("quotes", "opened")
    found = _records(pieces, F.col("open") == 0, "}")
    return found.withColumn("text", F.concat(F.regexp_replace("text", r"^[\s,\[]+", ""), F.lit("}"))).where(
        F.col("text").startswith("{"))


def split_json(spark: SparkSession, path, schema: T.StructType, order: Sequence[str] = ()) -> DataFrame:
    """The fields of ``schema`` of every record."""
    read = json_records(spark, path).select(*PLACE, F.from_json("text", schema).alias("fields"))
    return read.select("fields.*", *_places(order))


def _places(order: Sequence[str]) -> list[Column]:
    return [col(p).alias(n) for p, n in zip(PLACE, order)]
