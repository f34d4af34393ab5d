"""Metamorphic checks: duplicating the input changes results in a known way."""

from functools import reduce

from conftest import SF001, rows
from kestrel.operators import kmeans, mentions, qa, survey
from kestrel.plans import catalog
from kestrel.plans.tables import PRIORITIES, TERMS, table
from kestrel.sources import derived
from kestrel.sources.postings import parse_postings


def times(df, k):
    return reduce(lambda a, b: a.unionByName(b), [df] * k)


def test_rank_counts_scale_with_copies(spark):
    docs = catalog._documents(spark, SF001)
    base = dict(rows(mentions.mention_rank_full(docs, TERMS)))
    tripled = dict(rows(mentions.mention_rank_full(times(docs, 3), TERMS)))
    assert tripled == {t: 3 * n for t, n in base.items()}


def test_scores_and_pair_counts_with_duplicated_postings(spark):
    lines = derived.posting_lines(table(spark, SF001, "orders"), table(spark, SF001, "lineitem"))
    once, twice = parse_postings(lines), parse_postings(times(lines, 2))
    assert sorted(rows(qa.qa_high_score(twice))) == sorted(rows(qa.qa_high_score(once)))
    g1, g2 = dict(rows(qa.qa_grouped(once))), dict(rows(qa.qa_grouped(twice)))
    assert g2 == {i: 4 * n for i, n in g1.items()}  # 2 copies of each question x 2 of each answer
    assert qa.qa_pairs(twice).count() == 4 * qa.qa_pairs(once).count()


def test_survey_averages_unchanged_by_copies(spark):
    frame = derived.survey_frame(table(spark, SF001, "lineitem"))
    once = rows(survey.time_usage_grouped(survey.summary_from_frame(frame)))
    thrice = rows(survey.time_usage_grouped(survey.summary_from_frame(times(frame, 3))))
    assert once == thrice


def test_cluster_summary_with_duplicated_vectors(spark):
    vectors = catalog.qa_vectors(spark, SF001)
    centres = [(x, 0) for x in range(0, 50000 * len(PRIORITIES), 50000)]
    s1 = rows(kmeans.cluster_summary(kmeans.weighted_points(vectors), centres, PRIORITIES))
    s2 = rows(kmeans.cluster_summary(kmeans.weighted_points(times(vectors, 2)), centres, PRIORITIES))
    assert [(lab, pct, 2 * size, med) for lab, pct, size, med in s1] == s2
