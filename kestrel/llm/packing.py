"""Packing documents into training sequences by lexical retrieval (operator 11).

A document's tokens are cut at every full sequence; what is left (its rest, shorter than a sequence)
is packed with rests that share its rare tokens.  Sequences have ``size`` tokens; only the last ones of a
partition are shorter, and those are powers of two, so nothing is padded.

Method.  Rests are sorted by their two heaviest tokens under BM25 and cut into shards of
``SHARD`` neighbours in that order.  A shard has an inverted index, token to (rest, BM25 weight).  The next
unused rest is the seed of a window; the index scores all rests of the shard against the seed's
tokens, and the unused ones fill the window in falling order of score.  The one that doesn't fit is
cut, and its remainder is the next seed.  Document frequencies, the number of rests and their mean
length cover the whole corpus; there is one frequency per vocabulary entry, whatever the corpus.

Tokens.  The ids are those of the ``tokenizers`` library for the vocabulary file ``name``; ``tiktoken`` computes them
from the same vocabulary's rank file, which takes a third of the time, and the few texts that it
refuses (very long runs of white space) go to ``tokenizers``.  Texts beyond ``PART`` characters are
encoded in parts, cut where a space stands between two ASCII letters or digits: there the vocabulary's
pattern always starts a new piece.

Scale: the text is read and encoded once; only the rests, two bytes a token, are shuffled, once.  Ranges end
with the row number, so equal rests are spread over partitions however many there are.  A task holds one
shard (at most ``SHARD * size`` tokens) and broadcasts are one number per vocabulary entry.  An unfinished window
is handed on to the next shard of its partition.

Defined cases: NULL and empty texts are the end token alone; repeated rows are packed each; ties in
score go by the sorted order; NULL ids are ids; an empty table gives no rows; very long texts give full
sequences in place; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.order import PART_SHIFT
from kestrel.session import Held, owned

VOCABULARY = "byte_bpe_50k"
SIZE = 2048
END_ID = 1
SHARD = 512              # rests indexed together
PART = 1 << 20           # characters encoded at once
BATCH_TOKENS = 1 << 19   # tokens of one returned batch, about
K1, B = 1.2, 0.75        # BM25
CUT = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


class Encoder:
    """Ids of a public vocabulary, as ``tokenizers`` gives them without special tokens added."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.size = self.exact.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def _part(self, text: str) -> np.ndarray:
        try:
            ids = self.fast.encode(text, allowed_special="all")
        except ValueError:  # its regular expressions run out of stack on very long white space
            ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype)

    def __call__(self, text: str) -> np.ndarray:
        if len(text) <= PART:
            return self._part(text)
        parts, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + PART)
            end = cut.start() if cut else len(text)
            parts.append(self._part(text[at:end]))
            at = end
        return np.concatenate(parts)


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One per worker process."""
    return Encoder(name)


def ids_crc32(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def distinct_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids in order, how often each occurs)."""
    ids = np.sort(ids, kind="stable")  # a radix sort for 16-bit ids
    change = np.flatnonzero(ids[1:] != ids[:-1]) + 1
    starts = np.concatenate([[0], change, [len(ids)]])
    return ids[starts[:-1][:len(ids)]].astype(np.int64), np.diff(starts)[:len(ids)]


def tokenized(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, name: str = VOCABULARY,
              doc_id: str = "doc_id", text: str = "text", held: Held | None = None) -> DataFrame:
    """Per document (doc_id, doc_tokens, windows, rest): the crc32 of each full sequence, and the ids after them.

    One more row per task, its other columns NULL, has ``seen``: how many of the task's rests hold each id.
    Written to the shared folder: texts are encoded once.
    """
    kind = docs.schema[doc_id].dataType
    seen = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.LongType())])
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("doc_tokens", T.LongType()),
                           T.StructField("windows", T.ArrayType(T.LongType())), T.StructField("rest", T.BinaryType()),
                           T.StructField("seen", T.ArrayType(seen))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(name)
        frequency = np.zeros(ids_of.size, np.int64)
        names, kinds = ["doc_id", "doc_tokens", "windows", "rest", "seen"], None
        for batch in batches:
            kinds = [batch.schema.field(0).type, pa.int64(), pa.list_(pa.int64()), pa.binary(),
                     pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))]
            at = 0
            while at < batch.num_rows:
                start, counts, windows, rests, held = at, [], [], [], 0
                while at < batch.num_rows and held < BATCH_TOKENS:
                    ids = np.append(ids_of(batch.column(1)[at].as_py() or ""), ids_of.dtype.type(end_id))
                    full = len(ids) // size
                    counts.append(len(ids))
                    windows.append([ids_crc32(ids[i * size:(i + 1) * size]) for i in range(full)])
                    rest = ids[full * size:]
                    frequency[distinct_ids(rest)[0]] += 1
                    rests.append(rest.tobytes())
                    held += len(ids)
                    at += 1
                columns = [counts, windows, rests, [None] * len(counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, at - start),
                                                  *(pa.array(c, k) for c, k in zip(columns, kinds[1:]))], names)
        if kinds:
            counted = [{"id": int(i), "n": int(frequency[i])} for i in np.flatnonzero(frequency)]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([None] * 4 + [counted], kinds)], names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return (held or Held(docs.sparkSession)).store(rows.mapInArrow(encode, schema), "packing")


class Statistics:
    """BM25 weights under the document frequencies of the whole corpus."""

    def __init__(self, frequency: np.ndarray, rests: int, tokens: int):
        self.idf = np.log1p((rests - frequency + 0.5) / (frequency + 0.5))
        self.mean = tokens / max(rests, 1)

    def weights(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct ids, their BM25 weights) of a rest."""
        distinct, tf = distinct_ids(ids)
        norm = K1 * (1 - B + B * len(ids) / self.mean)
        return distinct, self.idf[distinct] * tf * (K1 + 1) / (tf + norm)


def statistics(tokens: DataFrame, vocabulary: int, dtype: np.dtype) -> Statistics:
    """Document frequencies, number and length of all rests of ``tokenized``, summed by Spark."""
    total = tokens.where(F.length("rest") > 0).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("rest")).alias("bytes")).first()
    frequency = np.zeros(vocabulary)
    seen = tokens.where(F.col("seen").isNotNull()).select(F.inline("seen"))
    for row in seen.groupBy("id").agg(F.sum("n").alias("n")).collect():
        frequency[row["id"]] = row["n"]  # at most one row per vocabulary entry
    return Statistics(frequency, total["n"], (total["bytes"] or 0) // dtype.itemsize)


def _keyed(rests: DataFrame, stats: Statistics, dtype: np.dtype) -> DataFrame:
    """``rests``, whose last column is the rest, with the two heaviest ids of each."""
    def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for rest in batch.column(batch.num_columns - 1):
                ids, weights = stats.weights(np.frombuffer(rest.as_buffer(), dtype))
                by = np.lexsort((ids, -weights))[:2]
                first.append(int(ids[by[0]]))
                second.append(int(ids[by[-1]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())],
                [*batch.schema.names, "first", "second"])

    schema = T.StructType([*rests.schema.fields, T.StructField("first", T.IntegerType()), T.StructField("second", T.IntegerType())])
    return rests.mapInArrow(heaviest, schema)


class Shard:
    """Inverted index of some rests."""

    def __init__(self, rests: list[np.ndarray], stats: Statistics):
        self.rests = rests
        found = [stats.weights(r) for r in rests]
        self.terms = [ids for ids, _ in found]
        ids = np.concatenate(self.terms)
        by = np.argsort(ids.astype(np.uint32), kind="stable")
        self.first = np.zeros(len(stats.idf) + 1, np.int64)  # of each id's postings
        np.cumsum(np.bincount(ids, minlength=len(stats.idf)), out=self.first[1:])
        self.rest = np.repeat(np.arange(len(rests)), [len(t) for t in self.terms])[by]
        self.weight = np.concatenate([w for _, w in found])[by]

    def ranked(self, terms: np.ndarray) -> np.ndarray:
        """All rests of the shard by falling BM25 score against ``terms``."""
        start = self.first[terms]
        count = self.first[terms + 1] - start
        postings = np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)
        scores = np.bincount(self.rest[postings], self.weight[postings], len(self.rests))
        return np.argsort(-scores, kind="stable")


class Packer:
    """Greedy windows over a partition's shards; ``pieces`` collects (row, start, length, crc32, window, offset).

    A ``row`` names a document in any way.
    """

    def __init__(self, stats: Statistics, size: int):
        self.stats, self.size = stats, size
        self.pieces: list[tuple] = []
        self.open: list[tuple] = []    # (row, start, ids) in the unfinished window
        self.held = 0                  # tokens in it
        self.terms = np.zeros(0, np.int64)  # of its seed
        self.window = 0

    def _close(self, pieces: list[tuple]) -> None:
        """One finished sequence."""
        offset = 0
        for row, start, ids in pieces:
            self.pieces.append((row, start, len(ids), ids_crc32(ids), self.window, offset))
            offset += len(ids)
        self.window += 1

    def _add(self, row, start: int, ids: np.ndarray) -> np.ndarray:
        """Put what fits into the window; returns the remainder."""
        fits = min(len(ids), self.size - self.held)
        self.open.append((row, start, ids[:fits]))
        self.held += fits
        if self.held == self.size:
            self._close(self.open)
            self.open, self.held = [], 0
        return ids[fits:]

    def shard(self, rows: list, starts: list[int], rests: list[np.ndarray]) -> None:
        index = Shard(rests, self.stats)
        unused = np.ones(len(rests), bool)
        seed = 0
        while True:
            if not self.held:  # a new window: the next unused rest is its seed
                while seed < len(rests) and not unused[seed]:
                    seed += 1
                if seed == len(rests):
                    return
                unused[seed] = False
                self.terms = index.terms[seed]
                self._add(rows[seed], starts[seed], rests[seed])
                continue
            ranked = index.ranked(self.terms)
            ranked = ranked[unused[ranked]]
            for k in ranked:
                unused[k] = False
                ids = rests[k]
                more = self._add(rows[k], starts[k], ids)
                if len(more):  # cut: its remainder is the next seed
                    self.terms = index.terms[k]
                    self._add(rows[k], starts[k] + len(ids) - len(more), more)
                if self.held == 0 or len(more):
                    break
            else:
                return  # all used: the window waits for the next shard

    def finish(self) -> None:
        """Cut what waits into sequences whose lengths are powers of two."""
        left, waiting = self.held, list(reversed(self.open))
        while left:
            want = 1 << left.bit_length() - 1
            left -= want
            some = []
            while want:
                row, start, ids = waiting.pop()
                some.append((row, start, ids[:want]))
                if len(ids) > want:
                    waiting.append((row, start + want, ids[want:]))
                want -= min(want, len(ids))
            self._close(some)
        self.open, self.held = [], 0


def _packed(rests: DataFrame, stats: Statistics, dtype: np.dtype, size: int, shard: int) -> DataFrame:
    """Pieces of sorted (doc_id, doc_tokens, start, rest); ``window`` counts within a partition."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(stats, size)
        kind = pa.null()
        rows, starts, held = [], [], []

        def out() -> pa.RecordBatch:
            found, packer.pieces = packer.pieces, []
            ids = pa.array([row[0] for row, *_ in found], kind)
            counts = pa.array([row[1] for row, *_ in found], pa.int64())
            rest = [pa.array([piece[i] for piece in found], pa.int64()) for i in range(1, 6)]
            return pa.RecordBatch.from_arrays([ids, counts, *rest],
                                              ["doc_id", "doc_tokens", "start", "length", "ids_crc32", "window", "offset"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for row, start, rest in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()),
                                        batch.column(2).to_pylist(), batch.column(3)):
                rows.append(row)
                starts.append(start)
                held.append(np.frombuffer(rest.as_py(), dtype))
                if len(held) == shard:
                    packer.shard(rows, starts, held)
                    rows, starts, held = [], [], []
                    yield out()
        if held:
            packer.shard(rows, starts, held)
        packer.finish()
        if packer.pieces:
            yield out()

    numbers = [T.StructField(c, T.LongType()) for c in ("doc_tokens", "start", "length", "ids_crc32", "window", "offset")]
    return rests.mapInArrow(pack, T.StructType([rests.schema["doc_id"], *numbers]))


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, name: str = VOCABULARY, shard: int = SHARD,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    Full sequences of one document have even ids, packed ones odd ids.  The result owns the tables that it
    reads (``session.close_result`` deletes them).
    """
    if size < 1 or shard < 1:
        raise ValueError("size and shard must be positive")
    known = encoder(name)
    held = Held(docs.sparkSession)
    tokens = tokenized(docs, size, end_id, name, doc_id, text, held)
    whole = tokens.where(F.size("windows") > 0).select("doc_id", "doc_tokens", F.posexplode("windows").alias("k", "crc"))
    whole = whole.select("doc_id", (F.col("k").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"),
                         F.col("crc").alias("ids_crc32"), "doc_tokens", (F.monotonically_increasing_id() * 2).alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))
    stats = statistics(tokens, known.size, known.dtype)
    rests = tokens.where(F.length("rest") > 0).select("doc_id", "doc_tokens", F.size("windows").alias("full"), "rest")
    # stored, since a range sort reads its input twice
    keyed = held.store(_keyed(rests, stats, known.dtype), "packing").withColumn("row", F.monotonically_increasing_id())
    sorted_rests = keyed.repartitionByRange("first", "second", "row").sortWithinPartitions("first", "second", "row")
    packed = _packed(sorted_rests.select("doc_id", "doc_tokens", (F.col("full").cast("long") * size).alias("start"), "rest"),
                     stats, known.dtype, size, shard)
    window = F.shiftleft(F.spark_partition_id().cast("long"), PART_SHIFT) + F.col("window")
    return owned(whole.unionByName(packed.withColumn("window", window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("window") * 2 + 1).alias("sequence_id"), "offset")),
        held)
