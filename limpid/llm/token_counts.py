"""Token counts through a cache keyed by digests of the content and of the tokenizer version.

A text is counted once per tokenizer version, wherever and how often it occurs: the texts are reduced to one
row per content digest inside the map tasks, digests that the cache holds are taken out, the rest is encoded and
appended to the cache, and every document joins its count by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm.chunks import library_encoder
from limpid.llm.tables import Scratch

CACHE = "tokenizer string, digest string, n_tokens long"


def tokenizer_digest(file: str) -> str:
    """The version of a tokenizer is the digest of its file."""
    with open(file, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _counter(file: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(file)
        for part in batches:
            counts = [len(encode.ids(t)) // 4 for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])
    return count


class CountCache:
    """A folder of stored counts, one sub-folder per tokenizer version, in shared storage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, tokenizer: str) -> DataFrame | None:
        """Counts of one version; a digest that two runs stored at the same time counts once."""
        if not self.exists():
            return None
        stored = self.spark.read.schema(CACHE).parquet(self.folder).where(F.col("tokenizer") == tokenizer)
        return stored.select("digest", "n_tokens")

    def append(self, tokenizer: str, counts: DataFrame) -> None:
        (counts.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens")
         .write.mode("append").partitionBy("tokenizer").parquet(self.folder))


def token_counts(df: DataFrame, id_column: str, text_column: str, file: str, cache: CountCache) -> DataFrame:
    """One row per row of ``df``: its id, ``n_bytes`` (UTF-8) and ``n_tokens`` as the tokenizers library counts.

    The content is normalised only by taking a missing text as empty, since any other change could change the
    count.  Repeated rows stay, a missing id stays missing, other columns are not read, an empty table gives
    no rows.
    """
    version = tokenizer_digest(file)
    text = F.coalesce(F.col(text_column), F.lit(""))
    docs = df.select(F.col(id_column), text.alias("text"), F.sha2(text, 256).alias("digest"))
    distinct = docs.groupBy("digest").agg(F.first("text").alias("text"))
    stored = cache.read(version)
    misses = distinct if stored is None else distinct.join(stored.select("digest"), "digest", "left_anti")
    cache.append(version, misses.mapInArrow(_counter(file), "digest string, n_tokens long"))
    counts = Scratch(df.sparkSession).keep(
        cache.read(version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return (docs.select(id_column, F.octet_length("text").cast("long").alias("n_bytes"), "digest")
            .join(counts, "digest").select(id_column, "n_bytes", "n_tokens"))
