from __spark_entry__ import entry, oracle_sql, queries


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["label", "percent", "size", "median"]
    got = df.collect()
    assert len(got) > 0
    assert [r.median for r in got] == sorted(r.median for r in got)


def test_contract_shapes():
    q = queries()
    o = oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())


def test_recorded_counts_at_sf0_01(spark):
    from conftest import SF01
    from kestrel.plans import catalog

    assert catalog.mention_count(spark, SF01).first()["n"] == 559
    expected = {"mention_postings": 4398, "mention_index": 13, "mention_rank_full": 15, "page_record_parse": 250,
                "posting_parse": 75000, "qa_pairs": 60000, "qa_grouped": 14743, "qa_vectors": 14743,
                "kmeans_assign": 130, "wide_table_read": 60000, "time_usage_summary": 51378,
                "time_usage_grouped": 12}
    got = {name: catalog.QUERIES[name](spark, SF01).count() for name in expected}
    assert got == expected


# The query names of SURVEY §2.14; column_groups classifies column names only (no data) and is
# tested as a function instead of being registered.
SURVEY_QUERIES = [
    "mention_count", "mention_postings", "mention_index", "mention_articles", "mention_rank_index", "mention_rank",
    "mention_rank_full", "page_record_parse", "posting_parse", "qa_pairs", "qa_grouped", "qa_high_score",
    "tag_index", "qa_vectors", "stratified_sample", "uniform_sample", "kmeans_assign", "kmeans_step",
    "kmeans_movement", "kmeans_fit", "kmeans_trace", "cluster_summary", "cluster_report", "wide_table_read",
    "time_usage_summary", "time_usage_typed", "time_usage_grouped", "time_usage_grouped_sql",
    "time_usage_grouped_typed",
]

# Further forms of the same operators: index blocks for any ids, compressed blocks, pairs in blocks.
MORE_FORMS = ["mention_index_text", "mention_bitmaps", "mention_rank_bitmap", "qa_grouped_pairs"]


def test_every_survey_query_is_registered_with_an_oracle():
    from kestrel.plans.catalog import QUERIES
    assert sorted(QUERIES) == sorted(SURVEY_QUERIES + MORE_FORMS)
    assert set(SURVEY_QUERIES + MORE_FORMS) <= set(queries()) and set(SURVEY_QUERIES) <= set(oracle_sql())
