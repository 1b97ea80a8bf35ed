"""The numbered operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (chat, decontamination, divergence, html_extraction, lm_scoring, merkle, mixing,
                          quality_classifier, quality_rules, simhash, substring_dedup, suffix_dedup, token_files)
from lakemart.llm.common import importable, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op9_chat_formatting", chat.ORACLE_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.chat_digests(chat.format_chats(rows.unionByName(extra)))


@query("op8_mixing_sources")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the cycle of weights 5, 2, 1."""
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).drop("source")


@query("op1_quality_rules", quality_rules.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basic counts, line frequency by host and the verdict for all documents."""
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents")).drop("clean_text")


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    out = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left by 13-word windows of smaller documents."""
    out = substring_dedup.remove_repeated_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op10_benchmark_decontamination", decontamination.ORACLE_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    return decontamination.contained_items(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark")).drop("h")


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned from ``labels``."""
    return quality_classifier.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents under bigrams of the training fold."""
    return lm_scoring.score_texts(read_table(spark, sf_dir, "documents"))


@query("op3_suffix_array_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents left by 200-byte strings found elsewhere."""
    return suffix_dedup.remove_repeated_bytes(read_table(spark, sf_dir, "documents")).drop("kept_text")


@query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extraction.extract_main_text(read_table(spark, sf_dir, "pages"))


@query("op13_merkle_manifest", merkle.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and checked proof of all documents; half of them tampered with."""
    out = merkle.merkle_manifest(read_table(spark, sf_dir, "documents"), tampered={"text": merkle.without_newlines()})
    return out.drop("path", "in_group")


@query("op12_source_divergence", divergence.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all sources of a language, and the terms that mark each source."""
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"))


@query("op11_token_files")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids in compressed files, read back."""
    import public_tokenizers
    return token_files.token_file_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
