import pytest
from pyspark.errors import PySparkException

from conftest import rows
from kestrel.operators import qa
from kestrel.session import Held
from kestrel.sources.postings import parse_postings, store_postings

LINES = [
    "1,10,12,,3,Java",
    "2,11,,10,-4,",
    "2,12,,10,7,",
    "1,20,,,0,PHP",
    "2,21,,20,-1,",
    "1,30,,,5,Ruby",
    "2,99,,77,9,",
    "3,50,,,1,Java",
]
LANGS = ["JavaScript", "Java", "PHP"]


def postings(spark, extra=()):
    df = spark.createDataFrame([(v,) for v in list(LINES) + list(extra)], "value string")
    return parse_postings(df)


def test_pairs(spark):
    got = sorted(rows(qa.qa_pairs(postings(spark))))
    assert got == [(10, "Java", 11, -4), (10, "Java", 12, 7), (20, "PHP", 21, -1)]


def test_grouped(spark):
    assert sorted(rows(qa.qa_grouped(postings(spark)))) == [(10, 2), (20, 1)]


def test_high_score_floor(spark):
    assert sorted(rows(qa.qa_high_score(postings(spark)))) == [(10, "Java", 7), (20, "PHP", 0)]


def test_duplicate_question_ids_give_one_row(spark):
    extra = ["1,10,,,0,Zeta"]
    assert sorted(rows(qa.qa_high_score(postings(spark, extra)))) == [(10, "Java", 7), (20, "PHP", 0)]
    # two copies of question 10, two answers: four pairs, as the pair grouping counts them
    assert sorted(rows(qa.qa_grouped(postings(spark, extra)))) == [(10, 4), (20, 1)]


def test_vectors(spark):
    scored = qa.qa_high_score(postings(spark))
    assert sorted(rows(qa.qa_vectors(scored, LANGS, 50000))) == [(10, 50000, 7), (20, 100000, 0)]


def test_vectors_unknown_language(spark):
    extra = ["1,60,,,1,Cobol", "2,62,,60,4,"]
    scored = qa.qa_high_score(postings(spark, extra))
    assert sorted(r[0] for r in rows(qa.qa_vectors(scored, LANGS))) == [10, 20]
    with pytest.raises(PySparkException, match="without a known language"):
        qa.qa_vectors(scored, LANGS, strict=True).collect()


def test_answer_without_parent(spark):
    extra = ["2,61,,,4,"]
    assert len(rows(qa.qa_pairs(postings(spark, extra)))) == 3
    with pytest.raises(PySparkException, match="answer without parent"):
        qa.qa_pairs(postings(spark, extra), strict=True).collect()


def test_tag_index(spark):
    got = dict(rows(qa.tag_index(qa.questions(postings(spark)), LANGS), "id", "lang_index"))
    assert got == {10: 1, 20: 2, 30: None}


def test_high_score_is_one_aggregate_without_join(spark):
    df = qa.qa_high_score(postings(spark))
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in opt and opt.count("Aggregate") == 1


def test_strict_parent_check_in_scoring(spark):
    with pytest.raises(PySparkException, match="answer without parent"):
        qa.qa_high_score(postings(spark, ["2,61,,,4,"]), strict=True).collect()


def test_type_three_and_orphans_ignored(spark):
    extra = ["3,10,,,100,", "2,98,,1234,50,"]
    assert sorted(rows(qa.qa_high_score(postings(spark, extra)))) == [(10, "Java", 7), (20, "PHP", 0)]


def test_pairs_plan_at_scale_is_sort_merge_join(spark):
    """Without broadcasting (large sides) the pair join is a sort-merge join on the question id."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = qa.qa_pairs(postings(spark))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(rows(df)) == [(10, "Java", 11, -4), (10, "Java", 12, 7), (20, "PHP", 21, -1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_high_score_by_tag_list_equals_texts(spark):
    extra = ["1,10,,,0,Zeta", "1,40,,,0,", "2,41,,40,2,"]
    want = sorted(rows(qa.qa_high_score(postings(spark, extra))))
    got = qa.qa_high_score(postings(spark, extra), tag_list=["Zeta", "PHP", "Java", "Ruby", "Unused"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(got)) == want and (40, None, 2) in want
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    with pytest.raises(PySparkException, match="tag not in the list: Zeta"):
        qa.qa_high_score(postings(spark, extra), tag_list=["PHP", "Java", "Ruby"]).collect()


def test_grouped_aggregates_numbers_only(spark):
    assert "SortAggregate" not in qa.qa_grouped(postings(spark))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 3, 4, 1000])
def test_grouped_pairs_in_blocks(spark, block):
    """A hot question over many partitions: full blocks in answer order, none above the block size."""
    lines = [f"1,{q},,,0,T{q}" for q in (1, 2, 3)] + [f"2,{100 + i},,{1 if i % 3 else 2},{i % 7}," for i in range(400)]
    pairs = qa.qa_pairs(parse_postings(spark.createDataFrame([(v,) for v in lines], "value string").repartition(5)))
    with Held(spark) as held:
        got = qa.qa_grouped_pairs(pairs, block=block, held=held).collect()
    for question in (1, 2):
        blocks = sorted((r for r in got if r.id == question), key=lambda r: r.block)
        assert [r.block for r in blocks] == list(range(len(blocks)))
        assert all(len(r.answers) == block for r in blocks[:-1]) and 0 < len(blocks[-1].answers) <= block
        assert [tuple(a) for r in blocks for a in r.answers] == [
            (100 + i, i % 7) for i in range(400) if (1 if i % 3 else 2) == question]
        assert {r.tags for r in blocks} == {f"T{question}"}
    assert not any(r.id == 3 for r in got)
    with pytest.raises(ValueError):
        qa.qa_grouped_pairs(pairs, block=0)


def test_grouped_pairs_of_repeated_rows(spark):
    """Equal pairs and repeated questions are all there, as in the join."""
    lines = ["1,1,,,0,A", "1,1,,,0,B"] + ["2,5,,1,3,"] * 50 + ["2,6,,1,,".replace(",,", ",0,", 0).replace(",1,,", ",1,4,")]
    pairs = qa.qa_pairs(parse_postings(spark.createDataFrame([(v,) for v in lines], "value string")))
    got = qa.qa_grouped_pairs(pairs, block=10).collect()
    assert sorted(len(r.answers) for r in got) == [2] + [10] * 10
    assert sorted(tuple(a) for r in got for a in r.answers) == [(5, 3)] * 100 + [(6, 4)] * 2


def test_pairs_of_stored_postings(spark):
    """One scan and parse: the join reads the stored table, by posting type."""
    with Held(spark) as held:
        stored = store_postings(postings(spark), held)
        pairs = qa.qa_pairs(stored)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(pairs)) == sorted(rows(qa.qa_pairs(postings(spark))))
        assert "split(" not in plan and plan.count("PartitionFilters: [isnotnull(posting_type") == 2
        assert sorted(rows(qa.qa_high_score(stored))) == sorted(rows(qa.qa_high_score(postings(spark))))
