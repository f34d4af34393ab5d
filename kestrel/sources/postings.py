"""Headerless, unquoted posting lines (S3).

Line layout: ``posting_type,id,accepted_answer,parent_id,score[,tags]``.  Type 1 is a question,
type 2 an answer.  Ids are parsed as BIGINT so that ids beyond 2^31 still fit at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import col, nullif_empty, require
from kestrel.session import Held

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("accepted_answer", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("tags", T.StringType()),
])

MODES = ("strict", "lenient")

FIELDS = (  # (name, SQL type, optional)
    ("posting_type", "int", False),
    ("id", "bigint", False),
    ("accepted_answer", "bigint", True),
    ("parent_id", "bigint", True),
    ("score", "int", False),
)


def parse_postings(lines: DataFrame, column: str = "value", mode: str = "strict") -> DataFrame:
    """Parse posting lines into ``POSTING_SCHEMA`` columns.

    Plain comma split, no quoting.  Empty accepted/parent fields are NULL; tags is NULL when
    the sixth field is absent or empty.  ``mode="strict"`` fails on a bad or missing number in any
    field, whatever columns the query reads (the rows are unfolded from an array that holds the
    checks, which pruning cannot remove); ``mode="lenient"`` yields NULL instead.

    Staged projections: the line is split once, each field is cast once, and the strict checks
    only read the cast results, so no parse work is repeated per row.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    split = lines.select(F.split(col(column), ",").alias("_f"))
    raw = [(nullif_empty(F.get("_f", i)) if optional else F.get("_f", i)).alias(f"_r{i}")
           for i, (_, _, optional) in enumerate(FIELDS)]
    tags = nullif_empty(F.get("_f", len(FIELDS))).alias("tags")
    texts = split.select(*raw, tags)
    typed = texts.select(*[F.col(f"_r{i}") for i in range(len(FIELDS))],
                         *[F.col(f"_r{i}").try_cast(dtype).alias(name) for i, (name, dtype, _) in enumerate(FIELDS)],
                         "tags")
    if mode == "lenient":
        return typed.select(*[name for name, _, _ in FIELDS], "tags")
    out = []
    for i, (name, _, optional) in enumerate(FIELDS):
        raw_i, value = F.col(f"_r{i}"), F.col(name)
        msg = F.concat(F.lit(f"bad posting field {name}: '"), F.coalesce(raw_i, F.lit("<missing>")), F.lit("'"))
        # an optional field may be empty (NULL text); a required one must parse
        out.append(require(value, msg, raw_i.isNotNull() if optional else None).alias(name))
    return typed.select(F.inline(F.array(F.struct(*out, "tags"))))


def read_postings(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Posting CSV file(s) -> ``POSTING_SCHEMA`` DataFrame."""
    return parse_postings(spark.read.text(path), mode=mode)


def store_postings(postings: DataFrame, held: Held) -> DataFrame:
    """Parsed postings as a table in the shared folder, one directory per posting type.

    For flows that read them more than once: lines are scanned and parsed here only, and a later
    ``posting_type`` test picks the directory, reading the columns that it needs.  ``held`` owns the files.
    """
    return held.store(postings, "postings", partition_by="posting_type")
