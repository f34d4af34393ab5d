"""Plan guards over the registered queries and the inputs that some collect on the way: no cross
joins, no Python rows, one scan per table, no shuffle of raw rows, no sort of all postings."""

import re

import pytest

from conftest import SF001
from kestrel.plans import catalog
from kestrel.session import Held

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonRDD", "REPARTITION_BY_NUM")
INPUTS = ["posting_parse", "qa_vectors", "stratified_sample", "uniform_sample"]  # of the k-means queries


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_forbidden_operators(spark, name):
    plan = executed(catalog.QUERIES[name](spark, SF001))
    allowed = {"REPARTITION_BY_NUM"} if re.search(r"SinglePartition, REPARTITION_BY_NUM", plan) else set()
    found = [op for op in FORBIDDEN if op in plan and op not in allowed]
    assert not found, f"{name}: {found}"
    assert not re.search(r"hashpartitioning[^\n]*REPARTITION_BY_NUM", plan)


@pytest.mark.parametrize("name", [*INPUTS, "mention_rank", "mention_articles", "time_usage_grouped", "wide_table_read"])
def test_every_table_is_scanned_once(spark, name):
    plan = executed(catalog.QUERIES[name](spark, SF001))
    tables = re.findall(r"sf0\.001/(\w+)\.parquet", plan)
    assert tables and len(tables) == len(set(tables)), tables


def test_pairs_read_one_stored_table(spark, monkeypatch):
    """The tables are scanned and parsed into a stored one; the join reads that, and can split skew."""
    stored = []
    monkeypatch.setattr(Held, "store", lambda self, df, *a, keep=Held.store, **b: (stored.append(df), keep(self, df, *a, **b))[1])
    plan = executed(catalog.qa_pairs(spark, SF001))
    assert not re.findall(r"sf0\.001/(\w+)\.parquet", plan) and "from_csv" not in plan and "split(" not in plan
    assert sorted(re.findall(r"sf0\.001/(\w+)\.parquet", executed(stored[0]))) == ["lineitem", "orders"]
    assert "REPARTITION" not in plan


@pytest.mark.parametrize("name", ["posting_parse", "wide_table_read"])
def test_row_checks_are_compiled(spark, name):
    """Whole rows are checked without an interpreted function of each row."""
    assert "lambda" not in executed(catalog.QUERIES[name](spark, SF001))


@pytest.mark.parametrize("name", [n for n in INPUTS if n != "posting_parse"] + ["qa_high_score", "qa_grouped"])
def test_postings_are_not_sorted(spark, name):
    assert "SortAggregate" not in executed(catalog.QUERIES[name](spark, SF001))
