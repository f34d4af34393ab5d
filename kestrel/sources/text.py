"""Line scans (S1) and framed page records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import check, col

# Fixed values of the page-record frame: a record looks like
#   <page><title> TITLE</title><text>TEXT  </text></page>
# The title starts at 0-based offset 14 and the text ends 16 characters before the line end.
PAGE_DELIMITER = "</title><text>"
TITLE_OFFSET = 14
TEXT_TAIL = 16

MODES = ("strict", "drop", "flag")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (S1).  Splittable, so large files spread over tasks."""
    return spark.read.text(path)


def parse_page_records(lines: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """Split each line into ``title`` and ``text`` at the first delimiter.

    Keeps every other input column and drops ``column``.  ``mode="strict"`` fails on a line
    without a well-formed frame (as the reference does); ``mode="drop"`` skips such lines;
    ``mode="flag"`` keeps them with NULL title and text and adds a boolean ``malformed``.
    Offsets count characters (code points).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    v = col(column)
    p = F.instr(v, PAGE_DELIMITER)  # 1-based, 0 when absent
    title_len = p - (TITLE_OFFSET + 1)
    text_start = p + len(PAGE_DELIMITER)
    text_len = F.length(v) - TEXT_TAIL - (text_start - 1)
    bad = F.coalesce((p == 0) | (title_len < 0) | (text_len < 0), F.lit(True))  # a NULL line is malformed
    title = v.substr(F.lit(TITLE_OFFSET + 1), title_len)
    text = v.substr(text_start, text_len)
    out = lines
    others = [c for c in lines.columns if c != column]
    if mode == "drop":
        out = out.where(~bad)
    elif mode == "flag":
        return out.select(*others, F.when(~bad, title).alias("title"), F.when(~bad, text).alias("text"),
                          bad.alias("malformed"))
    else:  # both columns carry the check, so a query reading either one fails on a bad line
        msg = F.concat(F.lit("malformed page record: "), F.coalesce(F.substring(v, 1, 80), F.lit("<null>")))
        title, text = check(title, bad, msg), check(text, bad, msg)
    return out.select(*others, title.alias("title"), text.alias("text"))


def read_page_records(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Page-record text file(s) -> (title, text)."""
    return parse_page_records(read_lines(spark, path), mode=mode)
