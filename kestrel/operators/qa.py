"""Questions and answers: pairing, grouping, high scores, language index, k-means vectors.

Input is a postings DataFrame with ``POSTING_SCHEMA`` columns (type 1 question, 2 answer).

Scale notes: grouping and scoring need no join at all: one aggregation keyed by question id
covers questions and answers together (one scan, partial aggregation, so a question holding a third of
all answers becomes one row per map task).  Where the tags are a known list, their numbers are
aggregated instead of texts, so the aggregation is hash-based.  Only the raw pair list (``qa_pairs``), whose
output is one row per pair, joins; it relies on AQE skew-join splitting for hot question ids.  A table
of parsed postings (``sources.store_postings``) saves its second scan and parse.  ``qa_grouped_pairs``
cuts each question's pairs into blocks of bounded size after a range sort, so that no question is
gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import label_at, position_in, require
from kestrel.functions.ordering import dense_positions, sorted_ids
from kestrel.session import Held

QUESTION, ANSWER = 1, 2


def questions(postings: DataFrame) -> DataFrame:
    """Questions (F3, P3): (id, tags)."""
    return postings.where(F.col("posting_type") == QUESTION).select("id", "tags")


def answers(postings: DataFrame, strict: bool = False) -> DataFrame:
    """Answers keyed by question (F3, P3): (answer_id, parent_id, score).

    An answer without a parent cannot be paired: ``strict=True`` fails on it (as the
    reference's ``parentId.get`` does); by default it is dropped by the inner joins.
    """
    a = postings.where(F.col("posting_type") == ANSWER)
    parent = F.col("parent_id")
    if strict:
        parent = require(parent, F.concat(F.lit("answer without parent: "), F.col("id").cast("string")))
    return a.select(F.col("id").alias("answer_id"), parent.alias("parent_id"), "score")


def qa_pairs(postings: DataFrame, strict: bool = False) -> DataFrame:
    """Inner equi-join of questions to their answers (J1): (id, tags, answer_id, score)."""
    q = questions(postings)
    a = answers(postings, strict).withColumnRenamed("parent_id", "id")
    return q.join(a, "id", "inner").select("id", "tags", "answer_id", "score")


def question_stats(postings: DataFrame, strict: bool = False, langs: Sequence[str] | None = None) -> DataFrame:
    """Per answered question, in one pass over all postings.

    With ``langs`` the tag is replaced by its position there (``lang_index``, smallest of a
    repeated question): all aggregated values are numbers then, so the aggregation is hash-based,
    while a smallest text is planned with a sort of the postings.

    Every posting is keyed by the question it belongs to (its own id for a question, its
    parent for an answer) and aggregated once: (id, q_n, tags, a_n, max_score).  Only ids with
    at least one question row and one answer survive, which is exactly the set the inner
    question/answer join produces.  No join is needed, the input is scanned once, and partial
    aggregation collapses the answers of a hot question on the map side.  Repeated question
    ids keep the smallest non-null tag (stated order).
    """
    key, counts = _keyed_counts(strict)
    tag = F.when(F.col("posting_type") == QUESTION, F.col("tags") if langs is None else position_in(list(langs), "tags"))
    smallest = F.min(tag).alias("tags" if langs is None else "lang_index")
    return postings.groupBy(key.alias("id")).agg(smallest, *counts).where(ANSWERED)


ANSWERED = "q_n > 0 AND a_n > 0"


def _keyed_counts(strict: bool) -> tuple[Column, list[Column]]:
    """Question id of a posting, and the numbers aggregated per question."""
    pt = F.col("posting_type")
    parent = F.col("parent_id")
    if strict:
        parent = require(parent, F.concat(F.lit("answer without parent: "), F.col("id").cast("string")),
                         pt == ANSWER)
    key = F.when(pt == QUESTION, F.col("id")).when(pt == ANSWER, parent)
    return key, [
        # rows without a key (other types, parentless answers) form the NULL group; it has no
        # question with an id, so the HAVING test drops it without a pushed-down filter
        F.count_if((pt == QUESTION) & F.col("id").isNotNull()).alias("q_n"),
        F.count_if(pt == ANSWER).alias("a_n"),
        F.max(F.when(pt == ANSWER, F.col("score"))).alias("max_score")]


def qa_grouped(postings: DataFrame, strict: bool = False) -> DataFrame:
    """Pairs grouped by question (A6): (id, n_answers) for questions with at least one answer.

    ``n_answers`` is the number of (question, answer) pairs, as the pair grouping counts them.
    ``qa_grouped_pairs`` has the pairs themselves, in blocks.
    """
    key, counts = _keyed_counts(strict)
    return postings.groupBy(key.alias("id")).agg(*counts).where(ANSWERED).select(
        "id", (F.col("q_n") * F.col("a_n")).alias("n_answers"))


DEFAULT_PAIR_BLOCK = 1024  # pairs of a block at most


def qa_grouped_pairs(pairs: DataFrame, block: int = DEFAULT_PAIR_BLOCK, held: Held | None = None) -> DataFrame:
    """Pairs grouped by question (A6), in blocks: (id, block, tags, answers array<struct<answer_id, score>>).

    ``pairs`` is ``qa_pairs``.  The answers of a question are numbered by answer id (then score and tag)
    and cut into blocks 0, 1, 2, … of ``block`` pairs; all but a question's last block are full, and its
    blocks in order are the whole group.  A repeated question pairs every row of it with every answer, as
    the join does; ``tags`` is the smallest of a block.

    The pairs are range-partitioned by (question, answer) and numbered there; a question that holds a
    third of all pairs lies in many partitions, and a block's task holds ``block`` pairs of it at a time.
    """
    if block <= 0:
        raise ValueError("block must be positive")
    # parts equal pairs over the partitions; their order doesn't matter
    told_apart = pairs.withColumn("_tie", F.monotonically_increasing_id())
    ordered = sorted_ids(told_apart, "id", "answer_id", "score", "tags", "_tie", name="_pos", held=held)
    ordered = dense_positions(ordered, "_pos")
    first = ordered.groupBy("id").agg(F.min("_pos").alias("_first"))
    number = F.col("_pos") - F.col("_first")
    placed = ordered.join(first, "id").withColumn("block", F.floor(number / block).cast("long"))
    answers_of = F.sort_array(F.collect_list(F.struct("_pos", "answer_id", "score")))
    return placed.groupBy("id", "block").agg(F.min("tags").alias("tags"), answers_of.alias("answers")).select(
        "id", "block", "tags", F.transform("answers", lambda a: F.struct(a["answer_id"], a["score"])).alias("answers"))


def qa_high_score(postings: DataFrame, strict: bool = False, tag_list: Sequence[str] | None = None) -> DataFrame:
    """Highest answer score per answered question, floored at 0 (A7): (id, tags, high_score).

    With ``tag_list``, which must name every tag that occurs (another one fails the query), the
    aggregation carries the tag's number in that list's text order and the text is looked up
    afterwards: it is hash-based then, with the same result.
    """
    score = F.greatest(F.lit(0), F.col("max_score")).alias("high_score")
    if tag_list is None:
        return question_stats(postings, strict).select("id", "tags", score)
    names = sorted(set(tag_list), key=str.encode)
    number = position_in(names, "tags")
    known = F.when(F.col("posting_type") == QUESTION, require(
        number, F.concat(F.lit("tag not in the list: "), F.col("tags")), F.col("tags").isNotNull()))
    key, counts = _keyed_counts(strict)
    stats = postings.groupBy(key.alias("id")).agg(F.min(known).alias("tag"), *counts).where(ANSWERED)
    return stats.select("id", label_at(names, "tag").alias("tags"), score)


def qa_indexed_score(postings: DataFrame, langs: Sequence[str], strict: bool = False) -> DataFrame:
    """``qa_high_score`` with the tag's position in ``langs``: (id, lang_index, high_score)."""
    return question_stats(postings, strict, langs).select(
        "id", "lang_index", F.greatest(F.lit(0), F.col("max_score")).alias("high_score"))


def left_out(postings: DataFrame, langs: Sequence[str]) -> DataFrame:
    """What a lenient model leaves out, one row: (answers_without_parent, questions_without_language)."""
    orphans = postings.agg(F.count_if((F.col("posting_type") == ANSWER) & F.col("parent_id").isNull())
                           .alias("answers_without_parent"))
    unknown = qa_indexed_score(postings, langs).agg(
        F.count_if(F.col("lang_index").isNull()).alias("questions_without_language"))
    return orphans.select("answers_without_parent", F.lit(0).cast("long").alias("questions_without_language")).unionByName(
        unknown.select(F.lit(0).cast("long").alias("answers_without_parent"), "questions_without_language")).agg(
        F.sum("answers_without_parent").alias("answers_without_parent"),
        F.sum("questions_without_language").alias("questions_without_language"))


def tag_index(df: DataFrame, langs: Sequence[str], tag_col: str = "tags") -> DataFrame:
    """Add ``lang_index``: 0-based position of the tag in ``langs``, NULL when absent."""
    return df.withColumn("lang_index", position_in(list(langs), tag_col))


def qa_vectors(scored: DataFrame, langs: Sequence[str], spread: int = 50000,
               strict: bool = False) -> DataFrame:
    """k-means vectors (P5): (id, x = lang_index * spread, y = high_score), one per question.

    ``scored`` has the tag (``qa_high_score``) or already its index (``qa_indexed_score``).

    A missing or unknown tag has no language: ``strict=True`` fails on it (as the reference
    does), the default drops the question.
    """
    if spread <= 0:
        raise ValueError("spread must be positive: the language is recovered as x div spread")
    idx = F.col("lang_index") if "lang_index" in scored.columns else position_in(list(langs), "tags")
    out = scored
    if strict:
        idx = require(idx, F.concat(F.lit("question without a known language: "), F.col("id").cast("string")))
    else:
        out = out.where(idx.isNotNull())
    return out.select("id", (idx * F.lit(spread)).cast("int").alias("x"),
                      F.col("high_score").cast("int").alias("y"))
