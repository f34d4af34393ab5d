"""Headed wide CSV (S4-S7): first column a quoted string id, every other column DOUBLE."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import col, quote_identifier, require

MODES = ("FAILFAST", "PERMISSIVE")


def wide_schema(header: Sequence[str]) -> T.StructType:
    """Schema from the header (S5): first field STRING, the rest DOUBLE.

    The reference declares every field non-null; Spark readers turn declared non-null fields
    into nullable ones, so non-nullness is enforced by ``mode="FAILFAST"`` instead.
    """
    names = list(header)
    if not names:
        raise ValueError("empty header")
    if len(set(names)) != len(names):
        raise ValueError("duplicate column names in header")
    return T.StructType([T.StructField(names[0], T.StringType())]
                        + [T.StructField(n, T.DoubleType()) for n in names[1:]])


def split_header(line: str) -> list[str]:
    """Header line -> names: comma split (quoted names unquoted), trailing empty names dropped.

    An unquoted header splits exactly as a plain comma split does.
    """
    return named(next(csv.reader([line]), []))


def named(fields: Sequence[str]) -> list[str]:
    """``fields`` without the empty names at the end."""
    names = list(fields)
    while names and names[-1] == "":
        names.pop()
    return names


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Fields of the first line of the (first) file: one small job that reads a single line."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"no header line in {path}")
    return next(csv.reader([first[0][0]]), [])


def _finish(rows: DataFrame, names: Sequence[str], mode: str) -> DataFrame:
    """Rows held as structs in column ``_row`` -> columns.

    All double quotes are removed from the first field only, and an empty first field is an empty
    id.  In FAILFAST every number must be there (the declared-non-null contract, kept as a check
    since readers make every field nullable).  The rows are unfolded from an array that holds the
    checks, so whole rows are validated whatever columns the consumer reads, and parsed once.
    """
    row = F.col("_row")
    out = [F.replace(F.coalesce(row[names[0]], F.lit("")), F.lit('"'), F.lit("")).alias(names[0])]
    for name in names[1:]:
        c = row[name]
        out.append((require(c, f"empty value in column {name}") if mode == "FAILFAST" else c).alias(name))
    return rows.select(F.inline(F.array(F.struct(*out))))


def read_wide_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> tuple[list[str], DataFrame]:
    """Read a headed wide CSV; return (column names, DataFrame).

    The reader skips the header line of every file and parses numbers as DOUBLE.  The header of
    every file is compared with that of the first one; a file with other names or another order
    fails the query in either mode.  FAILFAST also fails on a row with an unparsable, empty or
    missing number, or with too few or too many fields, whatever columns the query reads;
    PERMISSIVE gives NULL.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    first = read_header(spark, path)
    header = named(first)
    schema = wide_schema(header)
    # Columns without a name at the end of the header are read under that (empty) name, so that
    # Spark's comparison of the headers holds for them too, and dropped.
    for _ in first[len(header):]:
        schema = schema.add("", "string")
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
          .option("columnPruning", False).option("mode", mode).csv(path)).toDF(*[f"_c{i}" for i in range(len(first))])
    row = F.struct(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(header)])
    return header, _finish(df.select(row.alias("_row")), header, mode)


def parse_wide_lines(lines: DataFrame, header: Sequence[str], column: str = "value",
                     mode: str = "FAILFAST") -> DataFrame:
    """Parse data lines already held in a string column with the header-derived schema."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    schema = wide_schema(header)
    ddl = ", ".join(f"{quote_identifier(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv(col(column), ddl, {"mode": mode}).alias("_row"))
    return _finish(parsed, schema.fieldNames(), mode)
