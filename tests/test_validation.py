"""Invalid arguments fail early with a clear error, before any Spark job runs."""

import pytest

from kestrel.functions import literal_table
from kestrel.operators import kmeans, mentions, qa, sampling, survey
from kestrel.sources.postings import parse_postings
from kestrel.sources.text import parse_page_records
from kestrel.sources.wide_csv import parse_wide_lines, read_wide_csv, wide_schema


@pytest.fixture(scope="module")
def frames(spark):
    lines = spark.createDataFrame([("1,2,,,0,Java",)], "value string")
    vectors = spark.createDataFrame([(1, 0, 1)], "id long, x int, y int")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    return lines, vectors, docs


CASES = {
    "page mode": lambda s, f: parse_page_records(f[0], mode="bogus"),
    "posting mode": lambda s, f: parse_postings(f[0], mode="bogus"),
    "csv mode": lambda s, f: parse_wide_lines(f[0], ["id", "a"], mode="DROPMALFORMED"),
    "csv reader mode": lambda s, f: read_wide_csv(s, "/nonexistent", mode="bogus"),
    "duplicate header": lambda s, f: wide_schema(["id", "a", "a"]),
    "no terms": lambda s, f: mentions.mention_rank(f[2], []),
    "empty term": lambda s, f: mentions.mention_count(f[2], ""),
    "duplicate terms": lambda s, f: mentions.mention_postings(f[2], ["a", "a"]),
    "index block": lambda s, f: mentions.mention_index(mentions.mention_postings(f[2], ["a"]), block=0),
    "spread": lambda s, f: qa.qa_vectors(f[1].withColumnRenamed("y", "high_score"), ["a"], spread=0),
    "per stratum": lambda s, f: sampling.stratified_sample(f[1], 0),
    "sample size": lambda s, f: sampling.uniform_sample(f[1], 0),
    "iterations": lambda s, f: kmeans.fit(f[1], [(0, 0)], max_iterations=0),
    "no centres": lambda s, f: kmeans.assign(f[1], []),
    "movement lengths": lambda s, f: kmeans.total_movement([(0, 0)], [(0, 0), (1, 1)]),
    "empty group": lambda s, f: survey.hours([], "other"),
    "literal rows": lambda s, f: literal_table(s, [], [("a", "int")]),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_invalid_arguments(spark, frames, case):
    with pytest.raises(ValueError):
        CASES[case](spark, frames)


def test_trace_needs_keep_trace(spark, frames):
    from kestrel.operators import kmeans as km

    result = km.fit(frames[1], [(0, 0)])
    with pytest.raises(ValueError, match="keep_trace"):
        km.trace_frame(spark, result)
