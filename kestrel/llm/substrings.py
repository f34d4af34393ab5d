"""Exact substring dedup over words with a count-min prefilter (operator 8).

A window is ``WINDOW`` consecutive words of one document.  The first pass sketches window counts:
each document counts the anchor of every window once, partition sketches are merged by Spark, and
the merged counts never underestimate how many documents hold a window (see ``repeats``).  The
second pass hashes the windows that the sketch estimates repeated to 128 bits (two rolling hashes over two
independent hashes of each word) and groups those exactly: the smallest doc_id of each group keeps its window, every later document loses it.  No
repeated window is lost by the filter, and false alarms fall out of the groups.

Scale: only windows estimated repeated are shuffled, once.  Equal windows of one batch are settled
before that: only the smallest doc_id of the batch competes, so a passage that a third of all
documents share is a group of one row per batch, and the rest travels as one row per document.
Texts meet their removals in one join keyed by document.

Defined cases: NULL and blank texts have no words (0 removed, the hash of the empty string);
documents with the same doc_id do not remove each other's words; a NULL doc_id counts as larger
than any other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.repeats import Prefix, anchors, maybe_repeated, mixed, repeated_cells
from kestrel.llm.words import words

WINDOW = 50  # words
GRAM = 20    # words of the grams that anchor a window
PIECE = 1 << 18  # words hashed at once
FOLDED = 8       # steps of eight bytes of a word that are folded together with all words
SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)  # of the two hashes of a word, and what each step adds
STEPS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


OF_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first bytes


def word_hashes(text: str | None, count: int = 2) -> tuple[np.ndarray, ...]:
    """The first ``count`` of two independent 64-bit hashes per word.

    A word is folded eight bytes at a time, each of them mixed first, so no polynomial identity makes two
    words collide in one hash, let alone in both.
    """
    none = (np.zeros(0, np.uint64),) * count
    if not text:
        return none
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
    if not len(edge):
        return none
    starts, ends = edge[::2], edge[1::2]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    parts = [_folded(padded, starts[at:at + PIECE], ends[at:at + PIECE], count)  # so many words at once
             for at in range(0, len(starts), PIECE)]
    return tuple(np.concatenate(part) for part in zip(*parts))


def _folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` hashes of each range of ``data``, which has eight bytes more than the last end."""
    sizes = ends - starts
    hashes = [(sizes.astype(np.uint64) + np.uint64(seed)) * np.uint64(seed) for seed in SEEDS[:count]]
    # the eight bytes from every place on, as one number
    eights = np.ndarray((len(data) - 7,), np.dtype("<u8"), data.data, strides=(1,))
    open_, at = None, starts  # None: all words
    for _ in range(FOLDED):
        left = (ends if open_ is None else ends[open_]) - at
        chunk = mixed(eights[at] & OF_BYTES[np.minimum(left, 8)])
        for h, step in zip(hashes, STEPS):
            if open_ is None:
                h ^= chunk
                h *= np.uint64(step)
                h ^= h >> np.uint64(32)
            else:
                part = (h[open_] ^ chunk) * np.uint64(step)
                h[open_] = part ^ (part >> np.uint64(32))
        more = np.flatnonzero(left > 8)
        open_, at = more if open_ is None else open_[more], at[more] + 8
        if not len(open_):
            break
    for i, begin in zip(open_.tolist(), at.tolist()):  # the rest of very long words, one by one
        rest = data[begin:ends[i]].tobytes()
        for h in hashes:
            h[i] = xxhash.xxh64_intdigest(rest, seed=int(h[i]))
    return [mixed(h) for h in hashes]


def window_anchors(hashes: np.ndarray, prefix: Prefix | None = None) -> np.ndarray:
    """The anchor key of every window."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.uint64)
    grams = (prefix or Prefix(hashes, 1)).runs(GRAM)
    return grams[anchors(grams, WINDOW - GRAM + 1)]


def document_anchors(texts: list[str]) -> np.ndarray:
    """The anchor keys of every text, once per text."""
    found = [np.unique(window_anchors(*word_hashes(t, 1))) for t in texts]
    return np.concatenate([np.zeros(0, np.uint64), *found])


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def repeated_windows(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(h1, h2, doc, key, pos, lost): the windows that the sketch estimates repeated.

    Of equal windows in one batch only that of the smallest doc_id competes further.  The others
    are lost already: one row per document lists them in ``lost``, under a key of its own.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(bitmap)
    names = ["h1", "h2", "doc", "key", "pos", "lost"]
    places = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shipped.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found: list[tuple[np.ndarray, ...]] = []
            for i, text in enumerate(batch.column(2).to_pylist()):
                hashes, others = word_hashes(text)
                if len(hashes) < WINDOW:
                    continue
                one = Prefix(hashes, 1)
                at = np.flatnonzero(maybe_repeated(window_anchors(hashes, one), hot))
                if len(at):
                    found.append((one.runs(WINDOW)[at], Prefix(others, 2).runs(WINDOW)[at],
                                  np.full(len(at), i), at))
            if not found:
                continue
            h1, h2, row, pos = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((ids[row], h2, h1))
            h1, h2, row, pos = h1[order], h2[order], row[order], pos[order]
            doc = ids[row]
            first = np.concatenate(([True], (np.diff(h1) != 0) | (np.diff(h2) != 0)))
            later = doc > doc[np.flatnonzero(first)][np.cumsum(first) - 1]
            rivals = ~later
            keys = batch.column(1)
            n = int(rivals.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[rivals].view(np.int64)), pa.array(h2[rivals].view(np.int64)), pa.array(doc[rivals]),
                 keys.take(pa.array(row[rivals])), pa.array(pos[rivals].astype(np.int32)),
                 pa.nulls(n, places)], names)
            row, pos = row[later], pos[later]
            if len(row):
                order = np.lexsort((pos, row))
                row, pos = row[order], pos[order]
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1, [len(row)]))
                own = row[cuts[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[own]), pa.array(own.astype(np.int64)), pa.array(ids[own]), keys.take(pa.array(own)),
                     pa.nulls(len(own), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(pos.astype(np.int32)))], names)

    return docs.select("doc", "key", "text").mapInArrow(
        run, "h1 long, h2 long, doc long, key long, pos int, lost array<int>")


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc, key, starts, ends): merged word ranges to remove, one row per document that loses any.

    ``docs``: columns doc (order of the document), key (hash of the text) and text.  Rows equal in
    doc and key are copies with one doc_id, which lose the same words.
    """
    bitmap, = repeated_cells(docs, document_anchors)
    # At most one rival per batch (and rows of one doc_id) and window: a group is as large as the
    # number of batches, however many documents share its passage.
    group = Window.partitionBy("h1", "h2")
    late = repeated_windows(docs, bitmap).withColumn("least", F.min(F.when(F.col("lost").isNull(), F.col("doc"))).over(
        group)).where("lost is not null or doc > least")
    # bounded by the words of one document: copies of it lose the same, which the set keeps once
    return late.groupBy("doc", "key").agg(F.flatten(F.collect_set(F.coalesce("lost", F.array("pos")))).alias("pos")).select(
        "doc", "key", F.array_sort(F.array_distinct("pos")).alias("pos")).select("doc", "key", *_merged(F.col("pos")))


def _merged(pos: Column) -> list[Column]:
    """Maximal word ranges of windows at the sorted positions ``pos``."""
    before = F.concat(F.array(F.lit(None).cast("int")), F.slice(pos, F.lit(1), F.size(pos) - 1))
    after = F.concat(F.slice(pos, F.lit(2), F.size(pos)), F.array(F.lit(None).cast("int")))
    starts = F.array_compact(F.zip_with(pos, before, lambda p, b: F.when(b.isNull() | (p - b > WINDOW), p)))
    ends = F.array_compact(F.zip_with(pos, after, lambda p, a: F.when(a.isNull() | (a - p > WINDOW), p + WINDOW)))
    return [starts.alias("starts"), ends.alias("ends")]


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, starts, ends) per row; kept: what is left, words joined
    by a space; starts and ends: the removed word ranges."""
    keyed = docs.select("doc_id", "text", _order(F.col("doc_id")).alias("doc"),
                        F.xxhash64("text").alias("key"))
    spans = removed_spans(keyed.select("doc", "key", "text"))
    joined = keyed.join(spans, ["doc", "key"], "left")
    w = words(F.col("text"))
    rows = joined.select("doc_id", "starts", "ends", w.alias("w"))
    none = F.array().cast("array<int>")
    # the kept ranges lie between the removed ones
    begins = F.concat(F.array(F.lit(0)), F.coalesce("ends", none))
    stops = F.concat(F.coalesce("starts", none), F.array(F.size("w")))
    kept = F.when(F.col("starts").isNull(), F.col("w")).otherwise(F.flatten(F.zip_with(
        begins, stops, lambda b, s: F.slice(F.col("w"), b + 1, s - b))))
    out = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), "starts", "ends", kept.alias("_kept"))
    return out.select("doc_id", "n_words", (F.col("n_words") - F.size("_kept")).cast("long").alias("n_removed"),
                      F.array_join("_kept", " ").alias("kept"), "starts", "ends")
