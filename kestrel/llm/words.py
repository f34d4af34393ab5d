"""Word and text expressions shared by the operators (JVM-side built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six ASCII white-space characters; everything else belongs to a word.  Listed one by one:
# Java looks such a class up in a table, while ranges become a chain of tests.
SPACE = "\\x20\\x09\\x0A\\x0B\\x0C\\x0D"
SPACES = f"[{SPACE}]+"


def whole(text: Column) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of other than ASCII white space, in order (NULL: none)."""
    return F.array_remove(F.split(whole(text), SPACES), "")


def windows(ws: Column, n: int) -> Column:
    """All runs of ``n`` consecutive elements of an array column, as structs.

    ``ws`` must be a materialised column: it is referenced ``n`` times.
    """
    count = F.greatest(F.size(ws) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(ws, F.lit(k + 1), count) for k in range(n)])


def removed_length(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` the matches of ``pattern`` cover."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def row_key(*columns: Column) -> Column:
    """16 bytes that tell rows with different values in ``columns`` apart (NULL unlike any value).

    Rows equal in all of them share the key, so results computed per key hold for each copy.
    """
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    lengths = [F.length(p).cast("string") for p in parts]
    return F.unhex(F.md5(F.concat_ws(",", *lengths, *parts).cast("binary")))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` as one struct column ``row``, with copies of ``names``: no column of ``docs`` can clash with
    those of an operator.  ``select("row.*")`` unpacks it."""
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    return docs.select(row.alias("row"), *[F.col(n) for n in names])
