import pytest

from conftest import SF01, rows
from kestrel.operators import survey
from kestrel.plans import catalog
from kestrel.sources.wide_csv import read_wide_csv
from test_sources import SURVEY_CSV

HEADER = SURVEY_CSV.splitlines()[0].split(",")


def test_classify_columns():
    primary, work, other = survey.classify_columns(HEADER)
    assert primary == ["t010101", "t180101"]
    assert work == ["t050101", "t180501"]
    assert other == ["t020101", "t189999"]


@pytest.fixture(scope="module")
def summary(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("atus") / "atus.csv"
    path.write_text(SURVEY_CSV)
    _, df = read_wide_csv(spark, str(path))
    return survey.summary_from_frame(df)


def test_summary(summary):
    got = sorted(rows(summary))
    assert got == sorted([
        ("working", "male", "young", 2.0, 3.0, 1.0),
        ("working", "female", "active", 1.0, 0.0, 0.0),
        ("not working", "male", "elder", 2.0, 1.0, 1.0),
        ("working", "male", "elder", 0.0, 0.5, 0.0),
        ("not working", "female", "elder", 1.0, 0.0, 0.0),
    ])


def test_three_groupings_agree(summary):
    a = rows(survey.time_usage_grouped(summary))
    b = rows(survey.time_usage_grouped_sql(summary, "summed_test"))
    c = rows(survey.time_usage_grouped_typed(survey.time_usage_typed(summary)))
    assert a == b == c
    assert [r[:3] for r in a] == sorted(r[:3] for r in a)
    assert len(a) == 5


def test_typed_schema(summary):
    typed = survey.time_usage_typed(summary)
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    assert shape(typed.schema) == shape(survey.SUMMARY_SCHEMA)
    with pytest.raises(ValueError):
        survey.time_usage_typed(summary.drop("other"))


def test_rounding_modes_differ_at_negative_halves(spark):
    df = spark.createDataFrame([("w", "s", "a", -9.95, 0.25, 1.05)],
                               "working string, sex string, age string, primaryNeeds double, work double, other double")
    half_away = rows(survey.time_usage_grouped(df))[0]
    half_up = rows(survey.time_usage_grouped_typed(df))[0]
    assert half_away[3] == -10.0 and half_up[3] == -9.9
    assert half_away[4] == 0.3 and half_up[4] == 0.3


def test_empty_group_is_an_error():
    with pytest.raises(ValueError):
        survey.hours([], "work")


def test_sql_query_quotes_view_name():
    assert "FROM `my view`" in survey.grouped_sql_query("my view")


def test_driver_groupings_agree(spark):
    a = rows(catalog.time_usage_grouped(spark, SF01))
    b = rows(catalog.time_usage_grouped_sql(spark, SF01))
    assert a == b and len(a) == 12


def test_filter_reaches_scan(spark):
    df = catalog.time_usage_summary(spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linenumber), Not(EqualTo(l_linenumber,5))]" in plan
    read_schema = plan[plan.index("ReadSchema: struct<"):].split(">")[0]
    for used in ("l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        assert used in read_schema
    for unused in ("l_partkey", "l_returnflag", "l_linestatus", "l_shipdate"):
        assert unused not in read_schema
