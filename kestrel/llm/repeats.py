"""Shared parts of exact repeated-window search: rolling hashes, anchors and a count sketch.

A window of fixed length is anchored at the smallest hash of the grams inside it (leftmost on
ties).  Equal windows have equal anchors at equal offsets, and neighbouring windows mostly share
theirs, so counting anchors is many times cheaper than counting windows and never underestimates:
a window that occurs twice has an anchor that occurs twice.

The counts go into a count-min sketch of ``ROWS`` rows.  Every batch of a partition yields a
sparse sketch (cell, count); Spark merges them by a sum.  What leaves the cluster is one bit per
cell, "counted at least twice": at most ``MAX_CELLS`` bits per row whatever the input, which is
what makes it safe to broadcast.  Cells are allotted by input bytes up to that bound; beyond it
more windows pass the filter, and no repeated one is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 2
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 30
BYTES_PER_CELL = 16
BLOCK_BITS = 16        # cells of one bitmap block, as a power of two
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse, modulo 2**64."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        base = _BASES[which]
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        have = _powers[which] = (tables[0], tables[1])
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Prefix sums of a symbol sequence from which any run's rolling hash follows."""

    def __init__(self, symbols: np.ndarray, which: int):
        n = len(symbols)
        self.up, self.down = _power_tables(which, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * self.up[:n], out=self.sums[1:])

    def runs(self, length: int) -> np.ndarray:
        """Hashes of all runs of ``length`` symbols."""
        count = max(len(self.sums) - length, 0)
        return mixed((self.sums[length:] - self.sums[:count]) * self.down[:count])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def anchors(grams: np.ndarray, per_window: int) -> np.ndarray:
    """For every window of ``per_window`` grams, the position of its smallest hash, leftmost."""
    n = len(grams) - per_window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= per_window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < per_window:
        low = np.minimum(low[:n], low[per_window - width:per_window - width + n])
    return (low[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def cells(keys: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of every key in each row of the sketch; ``width`` is a power of two."""
    return [(mixed(keys + np.uint64(r)) & np.uint64(width - 1)).astype(np.int64) for r in range(ROWS)]


def sketch_width(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(MIN_CELLS, 1 << int(size // BYTES_PER_CELL).bit_length()), MAX_CELLS)


def repeated_cells(docs: DataFrame, keys_of: Callable[[list[str]], np.ndarray],
                   least: tuple[int, ...] | list[int] = (2,)) -> list[np.ndarray]:
    """One bitmap (rows, width / 8) per threshold: the cells counted that often over all texts.

    ``keys_of`` gives the anchor keys of a batch of texts, each as often as it counts.  The
    thresholds are in rising order.
    """
    width = sketch_width(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = np.unique(keys_of(batch.column(0).to_pylist()), return_counts=True)
            for r, cell in enumerate(cells(keys, width)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell * ROWS + r), pa.array(n.astype(np.int32))], ["cell", "n"])

    hot = (docs.select("text").mapInArrow(count, "cell long, n int").groupBy("cell").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= least[0]).select(
               (F.col("cell") % ROWS).cast("int").alias("r"), F.expr(f"cell div {ROWS}").alias("cell"),
               F.explode(F.array(*[F.when(F.col("n") >= m, F.lit(i)) for i, m in enumerate(least)])).alias("level"))
           .where("level is not null"))
    hot = hot.select((F.col("level") * ROWS + F.col("r")).alias("r"), "cell",
                     F.shiftright("cell", BLOCK_BITS).alias("block"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, np.zeros(1 << BLOCK_BITS, bool)

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()),
                 pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["r", "block", "bits"])

        for batch in batches:
            r, cell, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((np.diff(r) != 0) | (np.diff(at) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(r)]):
                if i == j:
                    continue
                if now != (int(r[i]), int(at[i])):
                    if now is not None:
                        yield block()
                    now, bits = (int(r[i]), int(at[i])), np.zeros(1 << BLOCK_BITS, bool)
                bits[cell[i:j] & ((1 << BLOCK_BITS) - 1)] = True
        if now is not None:
            yield block()

    blocks = (hot.repartition("r", "block").sortWithinPartitions("r", "block").select("r", "cell", "block")
              .mapInArrow(pack, "r int, block long, bits binary"))
    bitmap = np.zeros((len(least) * ROWS, width // 8), np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    for row in blocks.toLocalIterator():  # at most ROWS * MAX_CELLS bits per threshold
        part = np.frombuffer(row["bits"], np.uint8)[:width // 8]
        bitmap[row["r"], row["block"] * size:row["block"] * size + len(part)] = part
    return [bitmap[i * ROWS:(i + 1) * ROWS] for i in range(len(least))]


def maybe_repeated(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether the sketch's estimate (the least count over its rows) of each key reaches the bitmap's threshold."""
    out = np.ones(len(keys), bool)
    for r, cell in enumerate(cells(keys, bitmap.shape[1] * 8)):
        out &= (bitmap[r, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    return out


def merged_spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered ranges of windows at sorted ``starts``."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.concatenate(([0], new))], starts[np.concatenate((new - 1, [len(starts) - 1]))] + length
