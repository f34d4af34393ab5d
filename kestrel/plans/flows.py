"""End-to-end flows over a user's own files, one per family of the reference.

    mention_rankings(spark, path, terms)      page-record file -> three rankings and the index
    cluster_postings(spark, path, langs)      posting CSV      -> k-means model and cluster summary
    time_usage_by_life_period(spark, path)    headed wide CSV  -> grouped averages

Each returns DataFrames (the caller decides whether to ``show``, write or collect them).  The
clustering flow is also what the driver queries run on lines derived from the parquet tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import kmeans, mentions, qa, sampling, survey
from kestrel.session import Held
from kestrel.sources.postings import read_postings
from kestrel.sources.text import read_page_records
from kestrel.sources.wide_csv import read_wide_csv

# Fixed values of the reference's clustering input: the language list (order = index).
REFERENCE_LANGS = ["JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
                   "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy"]


def mention_rankings(spark: SparkSession, path: str, terms: Sequence[str] = tuple(REFERENCE_LANGS),
                     mode: str = "strict", block: int = mentions.DEFAULT_BLOCK) -> dict[str, DataFrame]:
    """Page-record file(s) -> documents, postings, index (ids, and with whole articles) and the
    three rankings.

    ``ranking`` keeps zero counts (all terms); ``ranking_from_index`` and ``ranking_combined``
    list mentioned terms only; all three agree on every mentioned term.  Page records carry no
    id, so documents get a positional ``doc_id`` (``monotonically_increasing_id``); each output
    is consistent in itself, and ids agree across outputs while the input is split the same way
    (same files, same parallelism).  With an id column of your own, call the operators in
    ``kestrel.operators.mentions`` directly.
    """
    docs = read_page_records(spark, path, mode=mode).withColumn("doc_id", F.monotonically_increasing_id())
    postings = mentions.mention_postings(docs, terms)
    index = mentions.mention_index(postings, block=block)
    return {
        "documents": docs.select("doc_id", "title"),
        "postings": postings,
        "index": index,
        "index_articles": mentions.index_articles(docs, terms),
        "ranking": mentions.mention_rank_full(docs, terms),
        "ranking_from_index": mentions.rank_from_index(index, terms),
        "ranking_combined": mentions.mention_rank(docs, terms),
    }


@dataclass
class ClusterModel:
    points: DataFrame           # weighted distinct points (x, y, n), in a stored table
    initial: list[kmeans.Centre]
    fit: kmeans.FitResult
    summary: DataFrame          # label, percent, size, median
    report: DataFrame           # formatted lines
    left_out: DataFrame | None = None  # lenient models: what they leave out, one row of counts
    held: Held | None = None    # owns the points

    def close(self) -> None:
        """Delete the stored points; the summary and report cannot be read any more."""
        if self.held is not None:
            self.held.close()

    def __enter__(self) -> ClusterModel:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


# Below this spread the languages are too close for per-language sampling to matter, and the
# initial centres are sampled from all vectors at once (fixed value of the reference).
UNIFORM_SPREAD_LIMIT = 500


def initial_centres(vectors: DataFrame, n_langs: int, k: int, seed: str,
                    spread: int = kmeans.KMeansParams.spread) -> list[kmeans.Centre]:
    """k initial centres ordered by (x, id); at most k rows reach the driver.

    Stratified (k / n_langs vectors per language, M1), or uniform over all vectors (M2) when
    ``spread`` is below ``UNIFORM_SPREAD_LIMIT``.
    """
    if k % n_langs != 0:
        raise ValueError("k must be a multiple of the number of languages")
    # Checked on the collected rows instead of inside the plan: every stratum gives at most
    # k / n_langs rows, so a short or missing stratum always leaves fewer than k.
    if spread < UNIFORM_SPREAD_LIMIT:
        picked = sampling.uniform_sample(vectors, k, seed=seed, strict=False)
    else:
        picked = sampling.stratified_sample(vectors, k // n_langs, n_langs, seed=seed, strict=False)
    rows = picked.orderBy("x", "id").select("x", "y").collect()
    if len(rows) != k:
        raise RuntimeError(f"expected {k} initial centres, got {len(rows)}: a language has too few "
                           "scored questions")
    return [(r["x"], r["y"]) for r in rows]


def cluster_model(postings: DataFrame, langs: Sequence[str], params: kmeans.KMeansParams = kmeans.KMeansParams(),
                  seed: str = sampling.DEFAULT_SEED, keep_trace: bool = False, strict: bool = True,
                  log_folder: str | None = None) -> ClusterModel:
    """Score, vectorise, sample, fit and summarise parsed postings.

    ``strict`` fails on an answer without a parent and on an answered question whose tag is
    missing or not in ``langs``, as the reference does.  Otherwise those are left out and
    ``left_out`` counts them.  The vectors are stored once (scanned and parsed once) and deleted when the initial
    centres and the weighted points exist; the points stay until the model is closed.  With
    ``log_folder`` (shared), every update is kept there and a new driver goes on from the last one.
    """
    langs = list(langs)
    spark = postings.sparkSession
    held = Held(spark)
    try:
        points, initial = weighted_vectors(postings, langs, params, seed, strict, held)
        log = kmeans.UpdateLog(spark, log_folder) if log_folder else None
        result = kmeans.fit(points, initial, params.eta, params.max_iterations, keep_trace=keep_trace, log=log)
    except BaseException:
        held.close()
        raise
    summary = kmeans.cluster_summary(points, result.centres, langs, params.spread)
    return ClusterModel(points, initial, result, summary, kmeans.cluster_report(summary),
                        None if strict else qa.left_out(postings, langs), held)


def weighted_vectors(postings: DataFrame, langs: Sequence[str], params: kmeans.KMeansParams, seed: str, strict: bool,
                     held: Held) -> tuple[DataFrame, list[kmeans.Centre]]:
    """(weighted points, initial centres) of parsed postings; ``held`` owns the points."""
    vectors = held.store(qa.qa_vectors(qa.qa_indexed_score(postings, langs, strict), langs, params.spread, strict),
                         "vectors")
    initial = initial_centres(vectors, len(langs), params.k, seed, params.spread)
    points = held.store(kmeans.weighted_points(vectors), "points")
    held.release(vectors)
    return points, initial


def cluster_postings(spark: SparkSession, path: str, langs: Sequence[str] = tuple(REFERENCE_LANGS),
                     params: kmeans.KMeansParams = kmeans.KMeansParams(), mode: str = "strict",
                     log_folder: str | None = None) -> ClusterModel:
    """Posting CSV file(s) -> fitted model, cluster summary and report.

    ``mode="strict"`` holds for the parser and for the scoring; ``"lenient"`` leaves out what
    cannot be used and reports how much that was.
    """
    return cluster_model(read_postings(spark, path, mode=mode), langs, params, strict=mode == "strict",
                         log_folder=log_folder)


def time_usage_by_life_period(spark: SparkSession, path: str, mode: str = "FAILFAST") -> dict[str, DataFrame]:
    """Headed wide CSV -> summary and the three grouped forms (DataFrame, SQL, typed)."""
    _, df = read_wide_csv(spark, path, mode=mode)
    summary = survey.summary_from_frame(df)
    typed = survey.time_usage_typed(summary)
    return {
        "summary": summary,
        "grouped": survey.time_usage_grouped(summary),
        "grouped_sql": survey.time_usage_grouped_sql(summary),
        "grouped_typed": survey.time_usage_grouped_typed(typed),
    }
