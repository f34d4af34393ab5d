"""Driver queries of the operators, with the SQL that checks them where SQL can express them.

Each query applies its operator with production parameters to its whole table and derives the
columns of its result contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (decontam, langid, licenses, mixing, packing, pages, pii, quality, repair, simhash,
                         spelling, substrings, suffixes)
from kestrel.llm.oracle import ORACLE_SQL  # noqa: F401
from kestrel.llm.words import documents
from kestrel.session import pass_on

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir)).documents()
    return pass_on(found, found.select("doc_id", "size", "source_size", "target", "taken", "source"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir),
                                  spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return pass_on(found, found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                       "component_id"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.table_quality(documents(spark, sf_dir))
    return pass_on(found, found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_bytes(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op11_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    occurrences = spelling.damaged(spelling.runs(documents(spark, sf_dir)))
    return spelling.variants(spelling.count_words(occurrences))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return repair.summaries(repair.damaged(turns), turns)


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_license_scan": op2_license_scan,
    "op3_html_text": op3_html_text,
    "op4_pii": op4_pii,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_lexical_packing": op11_lexical_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}
