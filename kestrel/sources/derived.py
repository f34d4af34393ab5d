"""Source-format inputs derived by Spark from the driver's parquet tables.

The reference reads three raw files that are not shipped with it (page records, posting lines,
a survey CSV).  These builders produce the same formats from the driver tables, row for row, so
the parsers and everything downstream run on data whose size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Header of the survey table derived from lineitem (chosen here: id, the three recoded fields,
# activity columns for every group plus one that belongs to no group).
SURVEY_HEADER = ["tucaseid", "telfs", "tesex", "teage",
                 "t010101", "t050101", "t180501", "t020101", "t170101"]


def _fields(*values) -> "F.Column":
    """Comma-joined fields; a NULL value becomes an empty field (``concat_ws`` alone would drop
    it and shift every later field)."""
    return F.concat_ws(",", *[F.coalesce(v.cast("string"), F.lit("")) for v in values])


def page_lines(pages: DataFrame) -> DataFrame:
    """pages -> (page_id, value) framed as ``<page><title> url</title><text>html  </text></page>``."""
    line = F.concat(F.lit("<page><title> "), F.coalesce(F.col("url"), F.lit("")), F.lit("</title><text>"),
                    F.coalesce(F.col("html"), F.lit("")), F.lit("  </text></page>"))
    return pages.select("page_id", line.alias("value"))


def posting_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders -> question lines, lineitem -> answer lines (column ``value``).

    question: ``1,<o_orderkey>,,,0,<o_orderpriority>``
    answer:   ``2,<l_orderkey*10+l_linenumber>,,<l_orderkey>,<int(l_quantity-25)>`` (no tags field)
    """
    q = orders.select(_fields(F.lit("1"), F.col("o_orderkey"), F.lit(""), F.lit(""), F.lit("0"),
                              F.col("o_orderpriority")).alias("value"))
    answer_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    score = (F.col("l_quantity") - 25).cast("int")
    a = lineitem.select(_fields(F.lit("2"), answer_id, F.lit(""), F.col("l_orderkey"), score).alias("value"))
    return q.unionByName(a)


def survey_frame(lineitem: DataFrame) -> DataFrame:
    """lineitem -> wide survey table with ``SURVEY_HEADER`` columns (id STRING, rest DOUBLE).

    telfs = l_linenumber, tesex = 1 for odd l_suppkey else 2, teage = l_quantity; activity
    minutes: t010101 = l_quantity (primary), t050101 = l_extendedprice and t180501 = l_tax
    (work), t020101 = l_discount (other), t170101 = l_partkey (in no group).
    """
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("tucaseid"),
        F.col("l_linenumber").cast("double").alias("telfs"),
        F.when(F.col("l_suppkey") % 2 == 1, F.lit(1.0)).otherwise(F.lit(2.0)).alias("tesex"),
        F.col("l_quantity").alias("teage"),
        F.col("l_quantity").alias("t010101"),
        F.col("l_extendedprice").alias("t050101"),
        F.col("l_tax").alias("t180501"),
        F.col("l_discount").alias("t020101"),
        F.col("l_partkey").cast("double").alias("t170101"),
    )


def survey_csv_lines(lineitem: DataFrame) -> DataFrame:
    """The survey table as CSV data lines (quoted id first), column ``value``."""
    frame = survey_frame(lineitem)
    first, rest = SURVEY_HEADER[0], SURVEY_HEADER[1:]
    quoted = F.concat(F.lit('"'), F.coalesce(F.col(first), F.lit("")), F.lit('"'))
    return frame.select(_fields(quoted, *[F.col(c) for c in rest]).alias("value"))
