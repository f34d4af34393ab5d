"""Benchmark decontamination by greedy string tiling (operator 5).

A document is compared with each benchmark item that it shares a seed of ``min_match`` consecutive
words with.  Greedy string tiling then marks the longest common runs of unmarked words, found by
running Karp-Rabin with a shrinking search length, until none of ``min_match`` words is left.  The
tiles do not overlap and may lie in any order, so reordered passages count like copied ones.  A
document is contaminated by an item if the tiles cover ``threshold`` of the item's words.

The benchmark is the query set: it is read in blocks of at most ``block_items`` items and
``block_words`` words, and each block's seed index, bounded by these, is broadcast.  The documents are
passed over once, whatever the number of blocks.  The seed join is a hash look-up on arrays of rolling hashes; a pair goes on only if
its seeds alone can cover the threshold, a necessary condition.  Documents are never shuffled.

Items of fewer than ``min_item_words`` words are too short for tiles to tell.  They are found exactly:
each is one hash of all its words, and a document that holds these words one after another is
contaminated with coverage 1.

Words are runs of lower-cased ASCII letters and digits and of characters beyond ASCII.  Defined
cases: NULL and empty texts hold no words and are clean; NULL items and those without a word are
ignored; repeated item ids are separate items, and ids may be of any type; an empty benchmark leaves
every document clean; a very long text costs its length and its seeds; repeated rows are judged alike; extra
columns pass through, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kestrel.llm.words import packed

MIN_MATCH = 4
THRESHOLD = 0.6
MIN_ITEM_WORDS = 8
BLOCK_ITEMS = 20000
BLOCK_WORDS = 1 << 20  # of a block's items
FIRST_LENGTH = 32   # of the search for tiles
BASE = 0x9E3779B97F4A7C15  # of the rolling hash, modulo 2**64

_TO_SPACE = bytes(c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def word_list(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` ids."""
    count = max(len(ids) - length + 1, 0)
    out = np.zeros(count, np.uint64)
    for k in range(length):
        out = out * np.uint64(BASE) + ids[k:k + count].astype(np.uint64)
    return out


def _windows(ids: list[int], marked: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of every unmarked run of ``length`` ids, each hash from the one before."""
    drop = pow(BASE, length, 1 << 64)
    value = run = 0
    for at, word in enumerate(ids):
        if marked[at]:
            value = run = 0
            continue
        value, run = (value * BASE + word + 1) % (1 << 64), run + 1
        if run > length:
            value, run = (value - (ids[at - length] + 1) * drop) % (1 << 64), length
        if run == length:
            yield value, at - length + 1


def greedy_tiles(item: list[int], doc: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (length, start in item, start in doc) of greedy string tiling; negative ids match nothing."""
    in_item, in_doc = [x < 0 for x in item], [x < 0 for x in doc]
    tiles, length = [], max(min_match, min(FIRST_LENGTH, len(item), len(doc)))
    while True:
        starts = defaultdict(list)
        for value, i in _windows(item, in_item, length):
            starts[value].append(i)
        found, longest = [], 0
        for value, j in _windows(doc, in_doc, length):
            for i in starts.get(value, ()):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not (
                        in_item[i + k] or in_doc[j + k]):
                    k += 1
                if k >= length:
                    found.append((k, i, j))
                    longest = max(longest, k)
        if longest > 2 * length:  # look for the longest ones first
            length = longest
            continue
        cut_short = False
        for k, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            free = 0
            while free < k and not (in_item[i + free] or in_doc[j + free]):
                free += 1
            if free == k:
                in_item[i:i + k] = in_doc[j:j + k] = [True] * k
                tiles.append((k, i, j))
            else:
                cut_short = True  # what is left of it may still reach this length
        if cut_short:
            continue
        if length == min_match:
            return tiles
        length = max(length // 2, min_match)


@dataclass
class Index:
    """One block of benchmark items: word numbers, their ids, and the seeds."""

    vocabulary: dict[bytes, int]
    ids: list[int]
    items: list[np.ndarray]
    seeds: np.ndarray                        # sorted hashes
    holders: list[list[tuple[int, int]]]     # (item, position) by seed
    short: dict[int, dict[int, list[int]]]   # items of so many words by the hash of them all
    min_match: int
    threshold: float

    def hits(self, text: str | None) -> list[tuple[int, float]]:
        """(item id, coverage) of the items that the text covers to the threshold."""
        ws = word_list(text)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        found = self._verbatim(ids) + self._tiled(ids)
        return sorted(((self.ids[item], coverage) for item, coverage in found), key=lambda x: (-x[1], x[0] is None, str(x[0])))

    def _verbatim(self, ids: np.ndarray) -> list[tuple[int, float]]:
        """Short items that stand in the text word for word."""
        found = set()
        for size, items in self.short.items():
            values = rolling(ids, size)
            at = np.flatnonzero(np.isin(values, np.fromiter(items, np.uint64, len(items))))
            for j, value in zip(at.tolist(), values[at].tolist()):
                found.update(i for i in items[value] if i not in found and (self.items[i] == ids[j:j + size]).all())
        return [(i, 1.0) for i in found]

    def _tiled(self, ids: np.ndarray) -> list[tuple[int, float]]:
        """Longer items that tiles cover to the threshold."""
        if len(ids) < self.min_match or not len(self.seeds):
            return []
        known = np.convolve(ids >= 0, np.ones(self.min_match, np.int64), "valid") == self.min_match
        at = np.flatnonzero(known)
        if not len(at):
            return []
        values = rolling(ids, self.min_match)[at]
        slot = np.minimum(np.searchsorted(self.seeds, values), len(self.seeds) - 1)
        same = self.seeds[slot] == values
        at, slot = at[same], slot[same]
        shared, places = defaultdict(set), defaultdict(set)
        for j, s in zip(at.tolist(), slot.tolist()):
            for item, i in self.holders[s]:
                shared[item].update(range(i, i + self.min_match))
                places[item].add(j)
        out = []
        for item, covered in shared.items():
            words = self.items[item]
            if len(covered) < self.threshold * len(words):
                continue
            # only words inside a seed can be in a tile: the rest of the document is left out
            inside = np.zeros(len(ids), bool)
            for j in places[item]:
                inside[j:j + self.min_match] = True
            keep = np.flatnonzero(inside)
            near: list[int] = []
            for n, (k, word) in enumerate(zip(keep.tolist(), ids[keep].tolist())):
                if n and k != keep[n - 1] + 1:
                    near.append(-1)
                near.append(word)
            tiles = greedy_tiles(words.tolist(), near, self.min_match)
            coverage = sum(t[0] for t in tiles) / len(words)
            if coverage >= self.threshold:
                out.append((item, round(coverage, 6)))
        return out


def build_index(items: list[tuple], min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                min_item_words: int = MIN_ITEM_WORDS) -> Index:
    vocabulary: dict[bytes, int] = {}
    ids, lists, seeds, short = [], [], defaultdict(list), defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        ws = word_list(text)
        if not ws:
            continue
        numbers = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], np.int64)
        if len(ws) < max(min_item_words, min_match):
            short[len(ws)][int(rolling(numbers, len(ws))[0])].append(len(ids))
        else:
            for i, value in enumerate(rolling(numbers, min_match).tolist()):
                seeds[value].append((len(ids), i))
        ids.append(item_id)
        lists.append(numbers)
    order = sorted(seeds)
    return Index(vocabulary, ids, lists, np.array(order, np.uint64), [seeds[v] for v in order],
                 {n: dict(of) for n, of in short.items()}, min_match, threshold)


def _blocks(benchmark: DataFrame, block_items: int, block_words: int) -> Iterator[list[tuple]]:
    """The items in order, in blocks of at most so many items and (but for the last item) words."""
    block, words = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").orderBy(
            "item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        words += len(word_list(row["text"]))
        if len(block) == block_items or words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def with_hits(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
              min_item_words: int = MIN_ITEM_WORDS, block_items: int = BLOCK_ITEMS,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, text, hits): ``docs`` packed, and the (item_id, coverage) of the items that contaminate each."""
    hit = T.StructType([T.StructField("item_id", benchmark.schema["item_id"].dataType), T.StructField("coverage", T.DoubleType())])
    out = packed(docs, "text").withColumn("hits", F.array().cast(T.ArrayType(hit)))
    context, kind = docs.sparkSession.sparkContext, to_arrow_type(T.ArrayType(hit))
    shipped = [context.broadcast(build_index(block, min_match, threshold, min_item_words))
               for block in _blocks(benchmark, block_items, block_words)]
    if not shipped:
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, text, _ = batch.columns
            texts = text.to_pylist()
            hits: list[list[dict]] = [[] for _ in texts]
            for block in shipped:
                for found, t in zip(hits, texts):
                    found.extend({"item_id": i, "coverage": c} for i, c in block.value.hits(t))
            yield pa.RecordBatch.from_arrays([row, text, pa.array(hits, kind)], ["row", "text", "hits"])

    return out.mapInArrow(run, out.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """(doc_id, contaminated, item_id, coverage, n_items, items): the best covered item first."""
    # best coverage first, then the smallest id (NULL last)
    ranked = F.array_sort(F.transform("hits", lambda h: F.struct(
        (-h["coverage"]).alias("c"), h["item_id"].isNull().alias("n"), h["item_id"].alias("i"), h.alias("hit"))))
    order = F.transform(ranked, lambda r: r["hit"])
    found = with_hits(docs.select("doc_id", "text"), benchmark, **params).select("row.doc_id", order.alias("hits"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"),
                        F.get("hits", F.lit(0))["item_id"].alias("item_id"),
                        F.coalesce(F.get("hits", F.lit(0))["coverage"], F.lit(0.0)).alias("coverage"),
                        F.size("hits").cast("long").alias("n_items"),
                        F.array_join(F.transform("hits", lambda h: h["item_id"].cast("string")), ",").alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the contaminated ones; columns unchanged."""
    return with_hits(docs, benchmark, **params).where(F.size("hits") == 0).select("row.*")
