"""The registered queries of this folder, each with its SQL twin or None."""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limpid.llm import language_codes, line_quality, merkle, oracles
from limpid.llm.byte_bpe import round_trip
from limpid.llm.dart_minhash import near_duplicates
from limpid.llm.embedding_neighbours import near_vectors
from limpid.llm.fill_in_middle import fill_in_middle, restored
from limpid.llm.html_extraction import extract
from limpid.llm.packing import pack_documents
from limpid.llm.quality_rules import COUNTS, fit_rules, judge
from limpid.llm.secret_scan import scan
from limpid.llm.sharding import plan_blocks, read_shards, rewrite_affected, slots_by_files, write_shards
from limpid.llm.tables import Scratch, table
from limpid.llm.token_counts import CountCache, token_counts


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "context", "step_group")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", vocabulary("word_bpe_49k.json"))
    return scanned.select("doc_id", F.size("findings").cast("long").alias("n_candidates"),
                          F.expr("filter(findings, f -> f.secret)").alias("secrets"),
                          F.sha2("clean", 256).alias("clean_sha256"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", Scratch(spark))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = line_quality.fit(documents, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return line_quality.score(documents, "text", chain).select(
        "doc_id", line_quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts through a cache that is empty at first, so that every run does the whole work."""
    cache = CountCache(spark, Scratch(spark).path("token-counts"))
    counts = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    coded = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ranks)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, "html").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", Scratch(spark))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an uneven layout (old shard by source) to eight shards of near equal bytes, texts and all.

    The old layout is written, its affected shards are rewritten, and the rows are read from the new files.
    """
    text, scratch = F.col("text"), Scratch(spark)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")
    first = table(spark, sf_dir, "documents").withColumn("shard", F.pmod(F.xxhash64("source"), F.lit(8)).cast("int"))
    write_shards(first, scratch.path("old-shards"))
    old = read_shards(spark, scratch.path("old-shards"), first.schema)
    plan = plan_blocks(old.select(size, "shard", "_own"), "size", "shard", "_own", 8)
    new = rewrite_affected(old, plan, scratch.path("new-shards"))
    numbered = slots_by_files(new.select("doc_id", size, crc, "shard", "old_shard", "_file", "_row"))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit_rules(documents, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return judge(documents, "text", rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule")


def op11_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    codes = language_codes.fit(documents, "text", "lang", ~held_out)
    return language_codes.identify(documents.select("doc_id", "text"), "text", codes).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, proof and roots, and the root that its leaf leads to, a third of the leaves tampered with."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(chosen, merkle.leaf_digest(*columns, lowered))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", merkle.leaf_digest(*columns, F.col("text")),
                           Scratch(spark), {"tampered": tampered}).rows
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_packing": (op1_packing, None),
    "op2_secret_scan": (op2_secret_scan, None),
    "op3_embedding_near_dedup": (op3_embedding_near_dedup, None),
    "op4_line_quality": (op4_line_quality, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_byte_bpe": (op6_byte_bpe, None),
    "op7_html_extraction": (op7_html_extraction, None),
    "op8_minhash_near_dedup": (op8_minhash_near_dedup, None),
    "op9_sharding": (op9_sharding, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_language_codes": (op11_language_codes, None),
    "op12_fill_in_middle": (op12_fill_in_middle, oracles.FILL_IN_MIDDLE),
    "op13_merkle_manifest": (op13_merkle_manifest, oracles.MERKLE),
}
