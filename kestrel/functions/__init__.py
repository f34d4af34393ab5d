"""Column-expression helpers shared by the operators (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_identifier(name: str) -> str:
    """A column or view name as a backtick-quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def tokens(text: str | Column) -> Column:
    """Split on the space character only.

    Tabs and newlines do not separate tokens, punctuation stays attached, and empty tokens
    between consecutive spaces are kept.
    """
    return F.split(col(text), " ")


def mentions(text: str | Column, term: str) -> Column:
    """True when ``term`` is one of the space-separated tokens of ``text`` (F1).

    ``instr`` is a cheap byte search that skips the split for texts without the substring.
    """
    t = col(text)
    return (F.instr(t, term) > 0) & F.array_contains(tokens(t), term)


def string_array(values: Sequence[str]) -> Column:
    """A literal ``array<string>`` (term lists, language lists)."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def position_in(values: Sequence[str], c: str | Column) -> Column:
    """0-based position of the first element of ``values`` equal to ``c``; NULL when absent."""
    pos = F.array_position(string_array(values), col(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def label_at(values: Sequence[str], index: str | Column) -> Column:
    """Reverse lookup ``values[index]`` (J5); NULL when out of range."""
    return F.get(string_array(values), col(index).cast("int"))


def _sql_number(value, dtype: str) -> str:
    """A numeric (or NULL) value as a typed SQL literal."""
    if value is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(value, bool):
        return f"CAST({'TRUE' if value else 'FALSE'} AS {dtype})"
    if isinstance(value, int):
        return f"CAST({value} AS {dtype})"
    if math.isnan(value):
        return f"CAST('NaN' AS {dtype})"
    if math.isinf(value):
        return f"CAST('{'' if value > 0 else '-'}Infinity' AS {dtype})"
    return f"CAST({float(value)!r}D AS {dtype})"


def literal_table(spark, rows: Sequence[tuple], fields: Sequence[tuple[str, str]]):
    """A small driver-held table (a parameter list, never data) built from literals.

    ``fields`` are (name, SQL type) pairs such as ``[("term", "string"), ("idx", "int")]``.
    The rows become one literal array of structs exploded by ``inline``: planned JVM-side with
    no Python-side RDD.  Rows of numbers are rendered as one SQL expression (one call to the
    JVM); other values go through ``lit``.
    """
    if not rows:
        raise ValueError("literal_table needs at least one row")
    numeric = all(v is None or isinstance(v, (int, float)) for row in rows for v in row)
    if numeric:
        structs = ", ".join(
            "named_struct(" + ", ".join(f"'{name}', {_sql_number(v, dtype)}" for v, (name, dtype) in zip(row, fields))
            + ")" for row in rows)
        array = F.expr(f"array({structs})")
    else:
        array = F.array(*[F.struct(*[F.lit(v).cast(dtype).alias(name) for v, (name, dtype) in zip(row, fields)])
                          for row in rows])
    return spark.range(1).select(F.inline(array))


def sort_bounded(df, *order):
    """Sort a result whose size is bounded by a parameter (terms, survey groups, clusters).

    Such a result is at most a few thousand rows: it is moved into one partition and sorted
    there, which skips the range-partitioning sample job of ``orderBy``.  ``repartition(1)``
    (not ``coalesce(1)``) keeps the aggregation that produced the rows fully parallel; only the
    bounded result crosses the exchange.  Never use it for data-sized results.
    """
    return df.repartition(1).sortWithinPartitions(*order)


def nullif_empty(c: str | Column) -> Column:
    """Empty string -> NULL."""
    return F.nullif(col(c), F.lit(""))


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared 2-D distance in DOUBLE (C16); no square root is taken."""
    dx = (x1 - x2).cast("double")
    dy = (y1 - y2).cast("double")
    return dx * dx + dy * dy


def round_half_up(c: str | Column, scale: int = 1) -> Column:
    """Round half toward +infinity at ``scale`` decimals, as Java's ``Math.round(v * 10^s) / 10^s``.

    ``Math.round`` is floor(x + 1/2) computed exactly; adding 0.5 in floating point is not
    exact (0.49999999999999994 + 0.5 == 1.0), so the fraction is tested instead (C18).
    """
    factor = float(10 ** scale)
    x = col(c) * F.lit(factor)
    down = F.floor(x)
    return (down + F.when(x - down >= F.lit(0.5), F.lit(1)).otherwise(F.lit(0))) / F.lit(factor)


def require(value: Column, message: Column | str, when_missing: Column | None = None) -> Column:
    """``value``, failing the task with ``message`` where it is NULL (and ``when_missing`` holds).

    Written as ``coalesce(value, raise_error(..))``: ``value`` appears once and the error
    branch is only evaluated for NULLs, so the check stays cheap even when the optimizer copies
    it into a pushed-down filter.
    """
    msg = F.lit(message) if isinstance(message, str) else message
    err = F.raise_error(msg)
    if when_missing is not None:
        err = F.when(when_missing, err)
    return F.coalesce(value, err)


def exactly(df, want: int, message: str):
    """``df`` unchanged, but the query fails unless ``df`` has exactly ``want`` rows.

    At most ``want`` + 1 rows are gathered into one array, whose size is tested; the rows are then
    unfolded again.  ``df`` is evaluated once, and the test holds whatever columns the consumer
    reads and for an empty ``df``.  Meant for bounded results (samples).
    """
    rows = df.limit(want + 1).agg(F.collect_list(F.struct(*[F.col(quote_identifier(c)) for c in df.columns]))
                                  .alias("__kestrel_rows"))
    got = F.col("__kestrel_rows")
    more = F.when(F.size(got) > want, F.lit("more")).otherwise(F.size(got).cast("string"))
    sized = F.when(F.size(got) == want, got).otherwise(F.raise_error(F.concat(F.lit(message + ", got "), more)))
    return rows.select(F.inline(sized))


def check(value: Column, bad: Column, message: Column | str) -> Column:
    """Return ``value``, failing the task with ``message`` on rows where ``bad`` is true.

    The check lives inside an output column, so the optimizer cannot prune it away and it runs
    distributed, row by row, without a separate job.
    """
    msg = F.lit(message) if isinstance(message, str) else message
    return F.when(bad, F.raise_error(msg)).otherwise(value)
