import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from kestrel.sources.postings import POSTING_SCHEMA, parse_postings, read_postings
from kestrel.sources.text import parse_page_records, read_page_records
from kestrel.sources.wide_csv import parse_wide_lines, read_wide_csv, split_header, wide_schema

PAGES = [
    "<page><title> Alpha</title><text>Java and C++ Java  </text></page>",
    "<page><title> Beta</title><text>JavaScript, Java  </text></page>",
    "<page><title> Gamma</title><text>java C++\tPHP  </text></page>",
]

POSTINGS = [
    "1,10,12,,3,Java",
    "2,11,,10,-4,",
    "2,12,,10,7,",
    "1,20,,,0,PHP",
    "2,21,,20,-1,",
    "1,30,,,5,Ruby",
    "2,99,,77,9,",
    "3,50,,,1,Java",
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_page_records_parse(spark):
    got = rows(parse_page_records(lines(spark, PAGES)))
    assert got == [("Alpha", "Java and C++ Java"), ("Beta", "JavaScript, Java"), ("Gamma", "java C++\tPHP")]


def test_page_records_keep_other_columns(spark):
    df = spark.createDataFrame([(7, PAGES[0])], "page_id long, value string")
    assert rows(parse_page_records(df)) == [(7, "Alpha", "Java and C++ Java")]


def test_page_records_first_delimiter(spark):
    line = "<page><title> T</title><text>a</title><text>b  </text></page>"
    assert rows(parse_page_records(lines(spark, [line]))) == [("T", "a</title><text>b")]


def test_page_records_malformed(spark):
    bad = lines(spark, PAGES + ["no frame here at all, just some text"])
    with pytest.raises(PySparkException, match="malformed page record"):
        parse_page_records(bad).collect()
    assert len(parse_page_records(bad, mode="drop").collect()) == 3


def test_page_records_flag_mode(spark):
    bad = lines(spark, PAGES[:1] + ["<page><title>x"])
    got = rows(parse_page_records(bad, mode="flag"))
    assert got == [("Alpha", "Java and C++ Java", False), (None, None, True)]


def test_page_records_from_file(spark, tmp_path):
    path = tmp_path / "wiki.dat"
    path.write_text("\n".join(PAGES) + "\n")
    assert [r.title for r in read_page_records(spark, str(path)).collect()] == ["Alpha", "Beta", "Gamma"]


def test_posting_parse(spark):
    df = parse_postings(lines(spark, POSTINGS))
    assert df.schema == POSTING_SCHEMA
    got = rows(df)
    assert got[0] == (1, 10, 12, None, 3, "Java")
    assert got[1] == (2, 11, None, 10, -4, None)  # trailing comma -> no tags
    assert got[7] == (3, 50, None, None, 1, "Java")


def test_posting_parse_missing_tags_field(spark):
    assert rows(parse_postings(lines(spark, ["2,61,,,4"]))) == [(2, 61, None, None, 4, None)]


def test_posting_parse_empty_sixth_field_then_more(spark):
    assert rows(parse_postings(lines(spark, ["1,5,,,0,,x"])), "tags") == [(None,)]


def test_posting_parse_bad_integer(spark):
    bad = lines(spark, ["1,x,,,1,Java"])
    with pytest.raises(PySparkException, match="bad posting field id"):
        parse_postings(bad).collect()
    assert rows(parse_postings(bad, mode="lenient")) == [(1, None, None, None, 1, "Java")]


def test_posting_parse_short_line(spark):
    with pytest.raises(PySparkException, match="bad posting field score"):
        parse_postings(lines(spark, ["1,5,,"])).collect()


def test_posting_parse_bad_optional(spark):
    with pytest.raises(PySparkException, match="bad posting field parent_id"):
        parse_postings(lines(spark, ["2,5,,abc,1"])).collect()


def test_read_postings_file(spark, tmp_path):
    path = tmp_path / "postings.csv"
    path.write_text("\n".join(POSTINGS) + "\n")
    assert read_postings(spark, str(path)).count() == len(POSTINGS)


SURVEY_CSV = """tucaseid,telfs,tesex,teage,t010101,t050101,t020101,t170101,t180101,t180501,t189999,t500101
"1",1,1,22,60,120,30,9,60,60,30,9
"2",2,2,23,60,0,0,0,0,0,0,0
"3",5,1,40,60,0,0,0,0,0,0,0
"4",3,1,56,120,60,0,0,0,0,60,0
"5",1,1,14,0,0,0,0,0,30,0,0
"6",0,2,22.5,30,0,0,0,30,0,0,0
"""


def test_split_header():
    assert split_header("a,b,,c,,") == ["a", "b", "", "c"]
    assert split_header('"id","t01 x",t02') == ["id", "t01 x", "t02"]


def test_wide_schema():
    s = wide_schema(["id", "x", "y"])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "double", "double"]
    with pytest.raises(ValueError):
        wide_schema([])


def test_read_wide_csv(spark, tmp_path):
    path = tmp_path / "atus.csv"
    path.write_text(SURVEY_CSV)
    names, df = read_wide_csv(spark, str(path))
    assert names[:4] == ["tucaseid", "telfs", "tesex", "teage"]
    assert df.columns == names
    got = df.orderBy("tucaseid").collect()
    assert [r.tucaseid for r in got] == ["1", "2", "3", "4", "5", "6"]
    assert got[5].teage == 22.5 and got[0].t010101 == 60.0


def test_read_wide_csv_bad_number(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,a\n\"1\",2\n\"2\",oops\n")
    _, strict = read_wide_csv(spark, str(path))
    with pytest.raises(Exception):
        strict.collect()
    _, lenient = read_wide_csv(spark, str(path), mode="PERMISSIVE")
    assert sorted(rows(lenient), key=str) == [("1", 2.0), ("2", None)]


def test_read_wide_csv_empty_value(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text('id,a,b\n"1",2,3\n"2",,4\n')
    _, strict = read_wide_csv(spark, str(path))
    with pytest.raises(PySparkException, match="empty value in column a"):
        strict.collect()
    for unread in (strict.select("id", "b"), strict.select("id"), strict.groupBy().count()):  # whole rows count
        with pytest.raises(PySparkException, match="empty value in column a"):
            unread.collect()
    _, lenient = read_wide_csv(spark, str(path), mode="PERMISSIVE")
    assert sorted(rows(lenient), key=str) == [("1", 2.0, 3.0), ("2", None, 4.0)]


def test_read_wide_csv_headers_of_all_files(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text("id,telfs,tesex\n1,2,3\n")
    (tmp_path / "w" / "b.csv").write_text("id,tesex,telfs\n4,5,6\n")
    for mode in ("FAILFAST", "PERMISSIVE"):
        _, df = read_wide_csv(spark, str(tmp_path / "w"), mode=mode)
        with pytest.raises(Exception, match="header|FAILED_READ_FILE"):  # Spark reports it as a failed file read
            df.select("telfs").collect()


def test_read_wide_csv_nameless_trailing_column(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,a,\n1,2,\n")
    header, df = read_wide_csv(spark, str(path))
    assert header == ["id", "a"] and rows(df) == [("1", 2.0)]


def test_read_wide_csv_empty_id_is_kept(spark, tmp_path):
    path = tmp_path / "i.csv"
    path.write_text("id,a\n,1\n")
    _, df = read_wide_csv(spark, str(path))
    assert rows(df) == [("", 1.0)]
    lines = spark.createDataFrame([(",1",)], "value string")
    assert rows(parse_wide_lines(lines, ["id", "a"])) == [("", 1.0)]


@pytest.mark.parametrize("line", ["1,2,bad", "1,2", "1,2,3,4"])
def test_failfast_validates_whole_rows(spark, tmp_path, line):
    path = tmp_path / "bad.csv"
    path.write_text(f"id,telfs,tesex\n{line}\n")
    _, df = read_wide_csv(spark, str(path))
    lines = spark.createDataFrame([(line,)], "value string")
    for frame in (df, parse_wide_lines(lines, ["id", "telfs", "tesex"])):
        with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE|empty value"):
            frame.select("telfs").collect()


def test_strict_postings_validate_whole_rows(spark):
    lines = spark.createDataFrame([("1,5,xx,,0,Java",)], "value string")
    for frame in (parse_postings(lines).select("id"), parse_postings(lines).groupBy().count()):
        with pytest.raises(PySparkException, match="bad posting field accepted_answer"):
            frame.collect()


def test_read_wide_csv_quote_removal(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,a\nx"y,1\n')
    _, df = read_wide_csv(spark, str(path))
    assert rows(df.select(F.col("id"))) == [("xy",)]


def test_null_line_is_malformed(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert rows(parse_page_records(df, mode="flag")) == [(None, None, True)]
    with pytest.raises(PySparkException, match="malformed page record"):
        parse_page_records(df).collect()


def test_derived_lines_keep_field_positions_for_nulls(spark):
    from kestrel.sources import derived

    orders = spark.createDataFrame([(None, "2-HIGH"), (7, None)], "o_orderkey long, o_orderpriority string")
    items = spark.createDataFrame([(None, 1, 30.0)], "l_orderkey long, l_linenumber int, l_quantity double")
    assert [r.value for r in derived.posting_lines(orders, items).collect()] == \
        ["1,,,,0,2-HIGH", "1,7,,,0,", "2,,,,5"]
    got = rows(parse_postings(derived.posting_lines(orders, items), mode="lenient"))
    assert got == [(1, None, None, None, 0, "2-HIGH"), (1, 7, None, None, 0, None), (2, None, None, None, 5, None)]


def test_parser_applies_to_a_stream(spark, tmp_path):
    """The stateless parsers work unchanged on a streaming DataFrame (in-process memory sink)."""
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("\n".join(POSTINGS[:2]) + "\n")
    stream = spark.readStream.format("text").load(str(src))
    q = (parse_postings(stream).writeStream.format("memory").queryName("kestrel_stream_test")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = rows(spark.sql("SELECT * FROM kestrel_stream_test ORDER BY id"))
    assert got == [(1, 10, 12, None, 3, "Java"), (2, 11, None, 10, -4, None)]
