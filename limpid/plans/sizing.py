"""Sizes the optimizer already knows, and a durable way to cut lineage."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

MB = 1 << 20
GB = 1 << 30

#: Inputs up to this estimate may use aggregates that keep one entry per distinct value.
SMALL_INPUT_BYTES = 32 * MB


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the result, without running a job.

    ``None`` when no estimate can be had; callers then take the scalable path.
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (Py4JError, PySparkException, AttributeError, ValueError):
        return None


def is_small(df: DataFrame, limit: int = SMALL_INPUT_BYTES) -> bool:
    size = plan_bytes(df)
    return size is not None and size <= limit


def input_bytes(df: DataFrame) -> int | None:
    """Estimated size of the tables that the plan reads, whatever it then makes of them; ``None`` without an estimate."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))
    except (Py4JError, PySparkException, AttributeError, ValueError):
        return None


def shared_folder(spark: SparkSession) -> str | None:
    """The shared scratch folder that the session names, or None."""
    return spark.conf.get("spark.checkpoint.dir", None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the table once to the shared folder and go on from the files.

    Later fit jobs then read only the columns they need from Parquet instead of
    repeating the shuffles above, and lost executors cost no recomputation.
    Without a shared folder the table is returned unchanged.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/limpid-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
