"""The constants of ``quality`` from labelled documents, and how they judge documents that were not used.

    python -m kestrel.llm.quality_fit SF_DIR            references of all labelled good documents
    python -m kestrel.llm.quality_fit SF_DIR --holdout  fitted on one half, counted on the other

A reference is the mean share, in millionths, of each class and common word over the distinct good
texts of a language that have ``min_words`` words or more and pass the base rules: one vote a text, so
copies do not move it.  Labels are (doc_id, quality); only documents that have one are read.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import quality
from kestrel.llm.quality import COMMON_WORDS, N_CLASSES, N_COMMON, P, QualityParams


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> dict:
    """{lang: (class shares, common-word shares, texts)} in millionths; one row per listed language is collected."""
    good = docs.where(F.col("lang").isin(list(COMMON_WORDS))).select("doc_id", "lang", "text").join(
        labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["lang", "text"])
    counted = quality._histograms(quality._base_columns(good, params))
    counted = counted.where((F.col(P + "n_words") >= params.min_words) & ~F.col(P + "base_failed"))

    def means(name: str, n: int) -> list:
        share = quality._share(F.col(P + name))
        return [F.round(F.avg(share[i]) * 1_000_000).cast("long").alias(f"{name}{i}") for i in range(n)]

    rows = counted.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), *means("classes", N_CLASSES),
                                       *means("common", N_COMMON)).collect()
    return {r["lang"]: ([r[f"classes{i}"] for i in range(N_CLASSES)], [r[f"common{i}"] for i in range(N_COMMON)], r["texts"])
            for r in rows}


def judged(docs: DataFrame, labels: DataFrame, fitted: dict) -> DataFrame:
    """(quality, n, kept) over labelled documents that pass the base rules, judged by ``fitted``."""
    refs = quality.fixed_references(docs.sparkSession, {k: v[:2] for k, v in fitted.items()})
    found = quality.quality(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), references=refs)
    return found.where(~F.col("base_failed")).join(labels.select("doc_id", "quality"), "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept"))


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents by the parity of the crc32 of their text, so that copies stay together."""
    odd = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 2 == 1
    return docs.where(~odd), docs.where(odd)


def main(sf_dir: str, holdout: bool) -> None:
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    docs, labels = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in ("documents", "labels"))
    used, unused = halves(docs) if holdout else (docs, None)
    fitted = fit(used, labels)
    for lang, (classes, common, texts) in sorted(fitted.items()):
        print(lang, texts, classes, common)
    if holdout:
        for row in judged(unused, labels, fitted).orderBy("quality").collect():
            print(f"labelled {'good' if row['quality'] else 'low'}, not used: {row['kept']} of {row['n']} kept")


if __name__ == "__main__":
    main(sys.argv[1], "--holdout" in sys.argv[2:])
