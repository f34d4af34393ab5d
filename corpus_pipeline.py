"""Corpus pipeline: quality rules, near-duplicates, decontamination, PII, source mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the
DataFrame that the next stage reads.  All but the last return the columns of ``documents``: the
first three drop rows, the fourth masks personal data inside the text.  The last returns one row
per remaining document with the words that the mix takes of it.

Defined cases are those of the operators; an empty table gives an empty mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import decontam, mixing, pii, quality, simhash
from kestrel.session import close_result, ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document."""
    return mixing.mix(docs).documents()


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_pii", mask_pii),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    Each stage's result is written as Parquet into the session's shared checkpoint folder and read
    again, so a lost executor costs at most one stage.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(f"{folder}/{name}")
        close_result(kept)
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
# The near-duplicate stage hashes with XXH64 and the mix draws by hash, which SQL cannot express;
# tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None
