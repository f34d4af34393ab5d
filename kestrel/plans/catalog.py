"""Driver query catalogue: one callable (spark, sf_dir) -> DataFrame per operator family.

Each query reads the driver's parquet tables (or inputs Spark derives from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import kmeans, mentions, qa, sampling, survey
from kestrel.plans import flows
from kestrel.plans.tables import (COUNT_TERM, K, PAIR_BLOCK, PARAMS, PER_STRATUM, PRIORITIES, SEED, SPREAD, TERMS,
                                  TEXT_BLOCK, table)
from kestrel.session import Held, owned
from kestrel.sources import derived
from kestrel.sources.postings import parse_postings, store_postings
from kestrel.sources.text import parse_page_records
from kestrel.sources.wide_csv import parse_wide_lines

Query = Callable[[SparkSession, str], DataFrame]


# --- mentions ---------------------------------------------------------------------------------

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def mention_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_count(_documents(spark, sf_dir), COUNT_TERM)


def mention_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_postings(_documents(spark, sf_dir), TERMS)


def mention_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.index_articles(_documents(spark, sf_dir), TERMS)


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_index(mention_postings(spark, sf_dir))


def mention_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ids joined into one string so that both engines hash the same value
    return _index(spark, sf_dir).select(
        "term", "block", F.array_join(F.col("doc_ids").cast("array<string>"), ",").alias("doc_ids"))


def mention_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_from_index(_index(spark, sf_dir), TERMS)


def mention_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index over text ids, in hashed blocks."""
    postings = mention_postings(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    return mentions.mention_index(postings, block=TEXT_BLOCK).select(
        "term", "block", F.array_join("doc_ids", ",").alias("doc_ids"))


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_bitmaps(mention_postings(spark, sf_dir))


def mention_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compressed index, unpacked again: its ids per term."""
    return mentions.bitmap_ids(_bitmaps(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def mention_rank_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.rank_from_bitmaps(_bitmaps(spark, sf_dir), TERMS)


def mention_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_rank(_documents(spark, sf_dir), TERMS)


def mention_rank_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.mention_rank_full(_documents(spark, sf_dir), TERMS)


# --- page records -----------------------------------------------------------------------------

def page_record_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_page_records(derived.page_lines(table(spark, sf_dir, "pages")))
    return parsed.select("page_id", "title", "text", F.length("text").alias("n"))


# --- questions and answers --------------------------------------------------------------------

def posting_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.posting_lines(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    return parse_postings(lines)


def _pairs(spark: SparkSession, sf_dir: str, held: Held) -> DataFrame:
    return qa.qa_pairs(store_postings(posting_parse(spark, sf_dir), held))


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = Held(spark)
    return owned(_pairs(spark, sf_dir, held), held)


def qa_grouped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = Held(spark)
    grouped = qa.qa_grouped_pairs(_pairs(spark, sf_dir, held), block=PAIR_BLOCK, held=held)
    # answers joined into one text so that both engines hash the same value
    text = F.array_join(F.transform("answers", lambda a: F.concat(a["answer_id"].cast("string"), F.lit(":"),
                                                                  a["score"].cast("string"))), ",")
    return owned(grouped.select("id", "block", "tags", text.alias("answers")), held)


def qa_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.qa_grouped(posting_parse(spark, sf_dir))


def qa_high_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.qa_high_score(posting_parse(spark, sf_dir), tag_list=PRIORITIES)


def tag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.tag_index(qa.questions(posting_parse(spark, sf_dir)), PRIORITIES)


def qa_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.qa_vectors(qa.qa_indexed_score(posting_parse(spark, sf_dir), PRIORITIES), PRIORITIES, SPREAD)


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_sample(qa_vectors(spark, sf_dir), PER_STRATUM, len(PRIORITIES), seed=SEED)


def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_sample(qa_vectors(spark, sf_dir), K, seed=SEED)


# --- k-means ----------------------------------------------------------------------------------

def _model_inputs(spark: SparkSession, sf_dir: str):
    """Weighted points, not materialised (they are read once), and the initial centres."""
    postings = posting_parse(spark, sf_dir)
    with Held(spark) as held:
        centres = flows.weighted_vectors(postings, PRIORITIES, PARAMS, SEED, True, held)[1]
    vectors = qa.qa_vectors(qa.qa_indexed_score(postings, PRIORITIES, True), PRIORITIES, SPREAD, True)
    return kmeans.weighted_points(vectors), centres


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, centres = _model_inputs(spark, sf_dir)
    return kmeans.assign(points, centres)


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, centres = _model_inputs(spark, sf_dir)
    return kmeans.step(points, centres)


def kmeans_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, centres = _model_inputs(spark, sf_dir)
    return kmeans.movement_frame(points, centres)


def _model(spark: SparkSession, sf_dir: str, keep_trace: bool = False) -> flows.ClusterModel:
    return flows.cluster_model(posting_parse(spark, sf_dir), PRIORITIES, PARAMS, SEED, keep_trace=keep_trace)


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _model(spark, sf_dir) as model:
        return kmeans.centres_frame(spark, model.fit.centres)


def kmeans_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _model(spark, sf_dir, keep_trace=True) as model:
        return kmeans.trace_frame(spark, model.fit)


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    return owned(model.summary, model.held)


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    return owned(model.report, model.held)


# --- time use ---------------------------------------------------------------------------------

def wide_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.survey_csv_lines(table(spark, sf_dir, "lineitem"))
    return parse_wide_lines(lines, derived.SURVEY_HEADER)


def time_usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return survey.summary_from_frame(derived.survey_frame(lineitem))


def time_usage_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_typed(time_usage_summary(spark, sf_dir))


def time_usage_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped(time_usage_summary(spark, sf_dir))


def time_usage_grouped_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped_sql(time_usage_summary(spark, sf_dir), "summed")


def time_usage_grouped_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped_typed(time_usage_typed(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "mention_count": mention_count,
    "mention_postings": mention_postings,
    "mention_index": mention_index,
    "mention_index_text": mention_index_text,
    "mention_bitmaps": mention_bitmaps,
    "mention_articles": mention_articles,
    "mention_rank_index": mention_rank_index,
    "mention_rank_bitmap": mention_rank_bitmap,
    "mention_rank": mention_rank,
    "mention_rank_full": mention_rank_full,
    "page_record_parse": page_record_parse,
    "posting_parse": posting_parse,
    "qa_pairs": qa_pairs,
    "qa_grouped": qa_grouped,
    "qa_grouped_pairs": qa_grouped_pairs,
    "qa_high_score": qa_high_score,
    "tag_index": tag_index,
    "qa_vectors": qa_vectors,
    "stratified_sample": stratified_sample,
    "uniform_sample": uniform_sample,
    "kmeans_assign": kmeans_assign,
    "kmeans_step": kmeans_step,
    "kmeans_movement": kmeans_movement,
    "kmeans_fit": kmeans_fit,
    "kmeans_trace": kmeans_trace,
    "cluster_summary": cluster_summary,
    "cluster_report": cluster_report,
    "wide_table_read": wide_table_read,
    "time_usage_summary": time_usage_summary,
    "time_usage_typed": time_usage_typed,
    "time_usage_grouped": time_usage_grouped,
    "time_usage_grouped_sql": time_usage_grouped_sql,
    "time_usage_grouped_typed": time_usage_grouped_typed,
}
