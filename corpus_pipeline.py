"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm import line_quality
from limpid.llm.dart_minhash import marked_copies
from limpid.llm.packing import pack_documents
from limpid.llm.quality_rules import fit_rules, judge
from limpid.llm.secret_scan import scan
from limpid.llm.tables import Scratch, table


def _packed(docs: DataFrame) -> DataFrame:
    """``text`` and ``row``, all other columns in one, so that a stage's own columns meet no names of the caller's."""
    return docs.select("text", F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("row"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base tests or a learned rule go.

    Null and empty texts have no words, so they go; rows that repeat are judged alike; an empty table stays empty.
    """
    rules = fit_rules(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return _unpacked(judge(_packed(docs), "text", rules).where("kept"), docs)


def line_labels(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly bad go; the chain learns from all documents, as the rules leave few bad ones.

    Null, empty and blank texts score 0, so they go; rows that repeat are judged alike; an empty table stays empty.
    """
    every = table(spark, sf_dir, "documents")
    chain = line_quality.fit(every, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return _unpacked(line_quality.score(_packed(docs), "text", chain).where("predicted = 1"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: smallest id, digest, text, then its other columns.

    Rows of one id are judged by their texts; rows without words (null and empty texts among them) or without an id
    stay, repeated ones too; an empty table stays empty.
    """
    marked = Scratch(spark).keep(marked_copies(docs, "doc_id", "text", Scratch(spark)).where("kept AND id IS NOT NULL")
                                 .select("id", "mark", "worded").distinct(), "kept")
    rows = _packed(docs).withColumns({"id": F.col("row.doc_id"), "mark": F.md5(F.coalesce("text", F.lit("")).cast("binary"))})
    key = ["id", "mark"]
    worded = rows.join(marked.where("worded"), key, "left_semi").groupBy(*key).agg(F.min(F.struct("row", "text")).alias("one"))
    wordless = rows.join(marked.where("NOT worded"), key, "left_semi")
    kept = worded.select("one.text", "one.row").unionByName(wordless.select("text", "row"))
    return _unpacked(kept.unionByName(rows.where("id IS NULL").select("text", "row")), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text, and ``n_chars``, where there is one, follows; all rows stay.

    Null and empty texts stay as they are (a null text has null characters); an empty table stays empty.
    """
    clean = scan(_packed(docs), "text", vocabulary("word_bpe_49k.json")).withColumn("text", F.col("clean"))
    out = _unpacked(clean, docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their ids.

    Null and empty texts are one piece with the end id alone; rows that repeat are packed each; an empty table gives
    no pieces; other columns are not read.
    """
    return pack_documents(docs, "doc_id", "text", vocabulary("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("line_quality", line_labels), ("minhash_near_dedup", near_dedup),
          ("secret_scan", secrets), ("packing", packing)]
#: Learned rules, a chain model, signatures, a forest and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
