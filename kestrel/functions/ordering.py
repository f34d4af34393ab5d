"""Sorted frames whose rows carry their place, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import Held, reliable_checkpoint

PART_SHIFT = 33  # of monotonically_increasing_id: partition index above, row number in the partition below


def sorted_ids(df: DataFrame, *order: str | Column, name: str = "id", held: Held | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with an increasing BIGINT ``name`` per row.

    The frame is written to the shared checkpoint folder (and owned by ``held``), so partitions, order
    and ids stay what they are for every later reader and after the loss of an executor.  Rows that
    are equal in ``order`` share a partition: add a column that tells them apart where they may be
    many.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn(name, F.monotonically_increasing_id())
    return held.checkpoint(placed) if held else reliable_checkpoint(placed)


def partition_starts(df: DataFrame, name: str = "id") -> list[tuple[int, int]]:
    """(partition, rows in the partitions before it) of a ``sorted_ids`` frame: one row a partition."""
    part = F.shiftrightunsigned(name, PART_SHIFT)
    rows = sorted((r["p"], r["n"]) for r in df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    out, before = [], 0
    for p, n in rows:
        out.append((p, before))
        before += n
    return out


def dense_positions(df: DataFrame, name: str = "id") -> DataFrame:
    """``df`` of ``sorted_ids`` with ``name`` replaced by 0, 1, 2, … in the same order.

    The starts of the partitions travel inside the plan as one literal array: one number a
    partition, whatever the rows.
    """
    starts = partition_starts(df, name)
    if not starts:
        return df
    lookup = [0] * (starts[-1][0] + 1)
    for p, before in starts:
        lookup[p] = before
    array = F.from_json(F.lit(str(lookup)), "array<bigint>")
    part = F.shiftrightunsigned(name, PART_SHIFT).cast("int")
    row = F.col(name).bitwiseAND(F.lit((1 << PART_SHIFT) - 1))
    return df.withColumn(name, F.get(array, part) + row)
