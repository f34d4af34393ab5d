"""Deterministic fixed-size samples (M1 per stratum, M2 uniform).

Rows are ranked by ``md5(seed || id)``, so the sample depends only on the data and the seed, never
on partitioning or arrival order.

Scale notes: the stratified sample is a bounded reservoir that merges.  A map task keeps the
``per_stratum`` smallest rows of each stratum that it has seen and shuffles those alone; two reservoirs merge
by keeping the smallest of both, first per (stratum, bucket) and then per stratum, so a task never sees
more than a bounded number of rows of one stratum at the end, however many rows or map tasks there
are.  Nothing is sorted but a batch and the reservoir, and the input is read once.  Spark has no
aggregate function with such a state, so this is the one place of the library that hands Arrow batches to
Python; all else stays in the JVM.  The uniform sample is a ``TakeOrderedAndProject`` (per-partition
top-k, then a k-row merge).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import exactly, quote_identifier

DEFAULT_SEED = "42:"
BUCKETS = (64, 8)  # reservoirs per stratum on the way to one
HELD_ROWS = 1 << 16  # a task with more rows than this in its reservoirs hands them on and starts anew


def sample_order(id_col: str = "id", seed: str = DEFAULT_SEED) -> Column:
    """Pseudo-random but reproducible rank key for a row."""
    return F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string")))


def smallest_per_key(table: pa.Table, n: int) -> pa.Table:
    """The ``n`` rows of each ``key`` that come first in ``rank`` (NULLs last), sorted by both."""
    table = table.take(pc.sort_indices(table, sort_keys=[("key", "ascending"), ("rank", "ascending")]))
    codes = table["key"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    return table.filter(pa.array(place < n))


def _reservoir(n: int, held_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reservoirs of all keys of a task; a full task emits them early, which later merges make good."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = smallest_per_key(rows if held is None else pa.concat_tables([held, rows]), n)
            if held.num_rows > held_rows:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return merged


def bottom_n(df: DataFrame, n: int, key: str, rank: Column, buckets: Sequence[int] = BUCKETS,
             held_rows: int = HELD_ROWS) -> DataFrame:
    """The ``n`` rows of every value of ``key`` that come first in ``rank`` (a text).

    NULL is a value of ``key`` like any other.  Rows of equal rank and key are interchangeable.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    rows = df.select(text.alias("key"), rank.alias("rank"),
                     F.struct(*[F.col(quote_identifier(c)) for c in df.columns]).alias("row"))
    merge = _reservoir(n, held_rows)
    rows = rows.mapInArrow(merge, rows.schema)
    for many in buckets:
        rows = rows.repartition("key", F.pmod(F.xxhash64("rank"), F.lit(many))).mapInArrow(merge, rows.schema)
    return rows.repartition("key").mapInArrow(merge, rows.schema).select("row.*")


def stratified_sample(df: DataFrame, per_stratum: int, n_strata: int | None = None,
                      key: str = "x", id_col: str = "id", seed: str = DEFAULT_SEED,
                      strict: bool = True, buckets: Sequence[int] = BUCKETS) -> DataFrame:
    """``per_stratum`` rows from every value of ``key`` (M1).

    With ``strict`` and ``n_strata`` the result must hold exactly ``per_stratum * n_strata``
    rows: every stratum gives at most ``per_stratum``, so that is "every expected stratum has
    enough rows", and the query fails otherwise (also on an empty input, and whatever columns
    the consumer reads).  Without ``n_strata``, every stratum present must have ``per_stratum``
    rows.  The checks run on the sample (at most that many rows).
    """
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    picked = bottom_n(df, per_stratum, key, sample_order(id_col, seed), buckets)
    if not strict:
        return picked
    if n_strata is not None:
        want = per_stratum * n_strata
        return exactly(picked, want, f"sample must hold {want} rows ({per_stratum} per stratum)")
    stratum = F.col(quote_identifier(key))
    rows = picked.groupBy(stratum.alias("stratum")).agg(
        F.collect_list(F.struct(*[F.col(quote_identifier(c)) for c in df.columns])).alias("rows"))
    short = F.raise_error(F.concat(F.lit(f"stratum has fewer than {per_stratum} rows: "),
                                   F.coalesce(F.col("stratum").cast("string"), F.lit("NULL"))))
    return rows.select(F.inline(F.when(F.size("rows") == per_stratum, F.col("rows")).otherwise(short)))


def uniform_sample(df: DataFrame, k: int, id_col: str = "id", seed: str = DEFAULT_SEED,
                   strict: bool = True) -> DataFrame:
    """``k`` rows without replacement, whatever their stratum (M2)."""
    if k <= 0:
        raise ValueError("k must be positive")
    picked = df.orderBy(sample_order(id_col, seed), F.col(id_col)).limit(k)
    return exactly(picked, k, f"sample must hold {k} rows") if strict else picked
