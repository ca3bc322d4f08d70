"""A profile that grows with its table: what was learned about earlier files is kept and merged, not read again.

A part's state are three tables: moments per column, counts per column and value, counts per row digest.  All of
them merge by adding up, so the profile of all parts together is exact, quantiles and distinct counts included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.functions.columns import as_number, fingerprint, is_missing, is_numeric_type, type_of
from limpid.operators.profile import _rows_from
from limpid.plans.frequencies import frequencies
from limpid.plans.grouped_quantiles import median_of_counts

COLUMNS = "place int, column string, dtype string, rows long, missing long, n long, mean double, m2 double, low double, high double"
VALUES = "column string, key string, number double, n long"
ROWS = "digest string, n long"


class ProfileState:
    """The state of a growing table, under one folder of shared storage; every :meth:`add` writes one part.

    A part is there when its ``columns`` table, written last, is: a part that a failed run left half done doesn't count.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def add(self, df: DataFrame) -> str:
        """Read a part of the table once for each of the three tables, and keep its state; gives the part's name."""
        part = uuid.uuid4().hex
        self._write(_value_counts(df), "values", part)
        self._write(_row_counts(df), "rows", part)
        self._write(_moments(df), "columns", part)
        return part

    def _write(self, df: DataFrame, table: str, part: str) -> None:
        df.write.parquet(f"{self.folder}/{table}/part={part}")

    def _read(self, table: str, schema: str, parts: list[str]) -> DataFrame:
        paths = [f"{self.folder}/{table}/part={p}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths)

    def parts(self) -> list[str]:
        """Names of all whole parts; a listing, no job over the data."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/columns")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return []
        names = [str(s.getPath().getName()) for s in system.listStatus(path)]
        return sorted(n.removeprefix("part=") for n in names if system.exists(
            self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/columns/{n}/_SUCCESS")))

    def report(self) -> DataFrame:
        """``(section, column, metric, value)`` of all parts together, as :func:`full_report` gives it for one table."""
        parts = self.parts()
        if not parts:
            raise ValueError("no part has been added")
        columns = _merged_moments(self._read("columns", COLUMNS, parts))
        kinds = columns.groupBy("column").agg(F.count_distinct("dtype").alias("kinds"), F.count("*").alias("n")).where("kinds > 1")
        if kinds.take(1):
            raise TypeError("parts disagree on the type of a column")
        values = self._read("values", VALUES, parts).groupBy("column", "key").agg(F.max("number").alias("number"), F.sum("n").alias("n"))
        repeated = self._read("rows", ROWS, parts).groupBy("digest").agg(F.sum("n").alias("n")).agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
        width = columns.count()
        shape = columns.agg(F.max("rows").alias("rows")).select("rows", F.lit(width).alias("columns"),
                                                                (F.col("rows") * width).alias("total_cells"))
        unique = columns.select("column").join(values.groupBy("column").agg(F.count("*").alias("found")), "column", "left").select(
            "column", F.coalesce("found", F.lit(0)).alias("unique"))
        gaps = columns.where("missing > 0").withColumn("percent", F.bround(F.col("missing") * 100.0 / F.col("rows"), 2))
        numeric = columns.where(F.col("number"))
        medians = median_of_counts(values.where("number IS NOT NULL").select("column", F.col("number").alias("v"), "n"), ["column"])
        numeric = numeric.join(medians.select("column", F.col("m").alias("median")), "column", "left").withColumn(
            "std", F.sqrt(F.col("m2") / F.when(F.col("n") > 0, F.col("n"))))
        return _long(("shape", shape, ("rows", "columns", "total_cells")), ("types", columns, ("dtype",)),
                     ("missing", gaps, ("missing", "percent")), ("duplicates", repeated, ("duplicate_rows",)),
                     ("unique", unique, ("unique",)),
                     ("numeric", numeric.withColumnsRenamed({"low": "min", "high": "max"}), ("mean", "median", "std", "min", "max")))


def _long(*parts: tuple[str, DataFrame, tuple[str, ...]]) -> DataFrame:
    out = None
    for section, frame, metrics in parts:
        name = F.col("column") if section not in ("shape", "duplicates") else F.lit(None).cast("string")
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics])
        made = frame.select(F.lit(section).alias("section"), name.alias("column"), F.inline(cells))
        out = made if out is None else out.unionByName(made)
    return out


def _numbers(df: DataFrame) -> list[str]:
    return [n for n in df.columns if is_numeric_type(type_of(df, n))]


def _moments(df: DataFrame) -> DataFrame:
    numeric = set(_numbers(df))
    aggs: list[Column] = [F.count("*").alias("rows")]
    for i, n in enumerate(df.columns):
        aggs.append(F.count_if(is_missing(df, n)).alias(f"g{i}"))
        if n in numeric:
            v = as_number(df, n)
            aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), F.var_pop(v).alias(f"v{i}"),
                     F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}")]
    none, rows = F.lit(None).cast("double"), []
    for i, f in enumerate(df.schema):
        own = {"n": F.col(f"n{i}"), "mean": F.col(f"a{i}"), "m2": F.col(f"v{i}") * F.col(f"n{i}"), "low": F.col(f"l{i}"),
               "high": F.col(f"h{i}")} if f.name in numeric else {
            "n": F.lit(None).cast("long"), "mean": none, "m2": none, "low": none, "high": none}
        rows.append({"place": F.lit(i), "column": F.lit(f.name), "dtype": F.lit(f.dataType.simpleString()), "rows": F.col("rows"),
                     "missing": F.col(f"g{i}"), **own})
    return _rows_from(df.agg(*aggs), rows)


def _merged_moments(columns: DataFrame) -> DataFrame:
    """One row per column; deviations are put together from the parts' own ones and those of their means."""
    means = columns.groupBy("column").agg((F.sum(F.col("n") * F.col("mean")) / F.when(F.sum("n") > 0, F.sum("n"))).alias("middle"))
    both = columns.join(means, "column")
    apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col("middle")) ** 2
    return both.groupBy("column", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.sum("n").alias("n"), F.max("middle").alias("mean"),
        F.sum(apart).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max(F.col("n").isNotNull()).alias("number"))


def _value_counts(df: DataFrame) -> DataFrame:
    numeric = set(_numbers(df))
    out = None
    for names, value in ((_numbers(df), None), ([n for n in df.columns if n not in numeric], fingerprint)):
        for table in frequencies(df, names, *([value] if value else [])) if names else []:
            number = F.lit(None).cast("double") if value else F.col("value").cast("double")
            made = table.select("column", F.col("value").cast("string").alias("key"), number.alias("number"), "n")
            out = made if out is None else out.unionByName(made)
    return out if out is not None else df.sparkSession.createDataFrame([], VALUES)


def _row_counts(df: DataFrame) -> DataFrame:
    """Rows by a digest of their cells, each with its length before it, so that no two rows share one by their borders."""
    cells = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in (fingerprint(df, n).cast("string") for n in df.columns)]
    digest = F.sha2(F.concat(*cells), 256) if cells else F.lit("")
    return df.select(digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("n"))
