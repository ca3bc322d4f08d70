"""Inputs and shared scratch tables of the operators in this folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables under one folder of the shared storage that ``spark.checkpoint.dir`` names.

    A kept table is written once and read back, so later jobs neither repeat the work before it nor lose it
    with an executor.  Without that setting the warehouse serves, which executors share too; a cluster whose
    warehouse is a local folder is refused, as its executors would write to disks of their own.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            shared = spark.conf.get("spark.sql.warehouse.dir")
            if urlparse(shared).scheme in ("", "file") and not re.match(r"local($|\[)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        self.root = f"{shared.rstrip('/')}/limpid-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def aside(name: str, taken: Iterable[str]) -> str:
    """The name under which a caller's column goes on: its own, with ``_in`` behind it where a result has it."""
    while name in taken:
        name += "_in"
    return name
