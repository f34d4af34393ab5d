"""Every registered query against its DuckDB statement at sf0.01 (the driver's correctness gate)."""

import os
import sys

import duckdb
import pytest

from conftest import SF01

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from kestrel.plans.catalog import QUERIES  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from compare import compare  # noqa: E402
from kestrel.plans.tables import TABLES  # noqa: E402

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    line = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF01)
    assert " FAIL " not in f" {line} " and "ERROR" not in line, line
