"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folds by crc32 of the id as text; fold 0 is held out from all fitting.
FOLDS = 5


def fold(id_column: str) -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))


#: Texts of one id that a sample holds, about.
TEXTS_PER_ID = 4


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, rows: int) -> DataFrame:
    """``id``, ``text`` and ``label`` of about ``rows`` labelled documents outside the held-out fold.

    Ids are drawn by a hash; all are taken when there are no more than ``rows``.  Labels that are missing or
    disagree for an id are left out.  Rows that repeat an id and a text count once, and of an id that stands on many
    texts about ``TEXTS_PER_ID`` are drawn, by a hash of the text.  So both sides are bounded: the labels before
    the join, which is why they may be broadcast, and the documents whatever one id holds.
    """
    usable = (labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & (fold(id_column) != 0))
              .groupBy(F.col(id_column).alias("labelled_id"))
              .agg(F.min(label_column).alias("label"), F.max(label_column).alias("other"))
              .where("label = other").drop("other"))
    ticket = F.pmod(F.xxhash64(F.col("labelled_id"), F.lit("sample")), F.lit(1 << 20))
    share = rows / max(usable.count(), 1)
    few = usable.where(ticket < int(share * (1 << 20))) if share < 1 else usable
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    held = known.select("id").join(F.broadcast(few), F.col("id") == F.col("labelled_id")).groupBy("labelled_id").agg(
        F.min("label").alias("label"), F.count(F.lit(1)).alias("rows"))
    place = F.pmod(F.xxhash64("text", F.lit("place")), F.lit(1 << 20))
    drawn = known.join(F.broadcast(held), F.col("id") == F.col("labelled_id")).where(
        place * F.col("rows") <= F.lit(TEXTS_PER_ID << 20))
    return drawn.groupBy("id", "label", F.xxhash64("text").alias("mark")).agg(F.min("text").alias("text")).select(
        "id", "text", "label")
