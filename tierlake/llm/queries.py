"""The registered queries of this subpackage: thin views on its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import (crosswalk, curves, leaks, licenses, passages, pieces, prefixes, quality, revisits, sharding,
                          simhash, toxicity, trees)
from tierlake.llm.common import table
from tierlake.llm.sql import ORACLE_SQL  # noqa: F401


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).select(
        "doc_id", sharding.row_bytes(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.sql(r"""SELECT -7L AS conv_id, t AS turn, r AS role, '\\### Assistant: </turn> ok' AS text
                            FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)""")  # fixed by the contract
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return trees.read_back(trees.format_best_paths(trees.conversations_as_trees(rows)))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, lossless="lossless")
    return coded.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                        F.size("ids").cast("long").alias("n_pieces"), "lossless", "ids")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *quality.MEASURES)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find_passages(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    resolved = revisits.resolve_revisits(revisits.captures_of(pages))
    whole = revisits.with_body(resolved, pages.select(
        (F.col("page_id") * 8).alias("response_id"), F.col("html").alias("body")))
    line = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return whole.select("record_id", "canonical", "ts", "status", "response_id",
                        F.array_join(line, "\n").alias("headers"), F.length("body").cast("long").alias("body_chars"),
                        F.md5("body").alias("body_md5"))


def op11_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosswalk.align(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefixes.rebuilt(prefixes.marked_turns(table(spark, sf_dir, "conversations")))
    return prefixes.prefix_trie(turns, convs)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_reply_trees": op3_reply_trees,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality_rules": op5_quality_rules,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_license_scans": op8_license_scans,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_warc": op10_warc,
    "op11_hilbert_ann": op11_hilbert_ann,
    "op12_cross_tokenizer": op12_cross_tokenizer,
    "op13_prefix_trie": op13_prefix_trie,
}
