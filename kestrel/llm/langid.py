"""Language identification by prediction by partial matching (operator 10).

Per language a variable-order byte context tree (contexts of 0 to ``ORDER`` bytes) gives each next
byte a code length.  A byte seen after the longest known context costs -log2 of its share; an
unseen one costs the escape of that context (method C: as many escape counts as distinct
successors) and is tried after the next shorter context, down to a uniform byte.  Statistics are
frozen after training, so the code length of a byte depends on the last ``ORDER`` + 1 bytes only.
The trees are therefore stored as tables of code lengths per n-gram, and a text is scored by
table lookups on whole arrays.  The language with the shortest code wins.

Training uses a bounded sample: ``sample_per_lang`` labelled documents of each language, smallest
hash of the id first, whole texts.  The n-gram counts are summed by Spark; the model (at most the
distinct n-grams of that sample) goes through the driver to the executors.  Prediction is
map-only and sees the text alone.

Letters are lower-cased and runs of ASCII non-letters become one space, in training as in
prediction.  Defined cases: NULL text or no letter gives ``und`` with score 0; a NULL id is
neither held out nor learned from; NULL lang is not learned from; without any labelled document
every text is ``und``; equal code lengths go to the first language by code point; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.sampling import stratified_sample

ORDER = 3
SAMPLE_PER_LANG = 400
SLICE = 1 << 22  # bytes scored at once
UNDETERMINED = "und"

_TO_SPACE = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def normal_bytes(text: str) -> bytes:
    """Lower-case letters, runs of ASCII non-letters as one space, ``ORDER`` spaces in front."""
    flat = text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE)
    return b" " * ORDER + b" ".join(flat.split()) + b" "


def grams(data: np.ndarray) -> np.ndarray:
    """All (ORDER + 1)-grams of a byte array as integers, first byte highest."""
    n = len(data) - ORDER
    out = np.zeros(max(n, 0), np.uint32)
    for k in range(ORDER + 1):
        out = (out << np.uint32(8)) | data[k:k + max(n, 0)]
    return out


class Table:
    """Open-addressing lookup of integer keys on whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        at = self._slot(self.keys)
        while len(left):
            self.probes += 1
            free = self.slots[at[left]] < 0
            cand = left[free]
            self.slots[at[cand]] = cand  # of keys that want one slot the last stays
            left = left[self.slots[at[left]] != left]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where absent."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        keys = keys.astype(np.uint64)
        at, todo = self._slot(keys), None
        for _ in range(self.probes):
            slot = self.slots[at]
            hit = (slot >= 0) & (self.keys[slot] == (keys if todo is None else keys[todo]))
            if todo is None:
                out[hit] = slot[hit]
                todo = np.flatnonzero(~hit & (slot >= 0))
                at = at[todo]
            else:
                out[todo[hit]] = slot[hit]
                more = ~hit & (slot >= 0)
                todo, at = todo[more], at[more]
            if not len(todo):
                break
            at = (at + 1) & ((1 << self.bits) - 1)
        return out


@dataclass
class Level:
    """Contexts of one length: escape costs, and costs of (context, byte) pairs, by language."""

    contexts: Table
    escapes: np.ndarray   # (contexts, languages); 0 where the language lacks the context
    pairs: Table
    costs: np.ndarray     # (pairs, languages), escapes and shorter contexts included


@dataclass
class Model:
    langs: list[str]
    levels: list[Level]   # by context length, 0 first

    def cost(self, keys: np.ndarray, order: int | None = None) -> np.ndarray:
        """Code lengths in bits (keys, languages) of the last byte of each gram."""
        order = len(self.levels) - 1 if order is None else order
        if order < 0:
            return np.full((len(keys), len(self.langs)), 8.0, np.float32)
        level = self.levels[order]
        at = level.pairs.find(keys)
        out = level.costs[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            short = keys[miss]
            lower = self.cost(short & np.uint32((1 << (8 * order)) - 1), order - 1)
            known = level.contexts.find(short >> np.uint32(8))
            out[miss] = lower + np.where(known[:, None] >= 0, level.escapes[known], 0)
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Total code length (texts, languages) of normalised texts."""
        total = np.zeros((len(texts), len(self.langs)))
        sizes = np.array([len(t) - ORDER for t in texts])
        group, held = [], 0
        for i, t in enumerate(texts):
            if len(t) > SLICE:  # a very long text goes piece by piece
                data = np.frombuffer(t, np.uint8)
                for s in range(0, len(t) - ORDER, SLICE):
                    total[i] += self.cost(grams(data[s:s + SLICE + ORDER])).sum(axis=0, dtype=np.float64)
                continue
            group.append(i)
            held += len(t)
            if held > SLICE or i == len(texts) - 1:
                self._add(texts, group, sizes, total)
                group, held = [], 0
        if group:
            self._add(texts, group, sizes, total)
        return total

    def _add(self, texts: list[bytes], group: list[int], sizes: np.ndarray, total: np.ndarray) -> None:
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        lengths = sizes[group] + ORDER
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        costs = self.cost(grams(data)).astype(np.float64)
        # sums per text; the grams that run into the next text fall into its first ORDER places
        edges = np.stack([begins, begins + lengths - ORDER], axis=1).ravel()
        sums = np.add.reduceat(np.concatenate([costs, np.zeros((ORDER + 1, costs.shape[1]))]), edges, axis=0)
        total[group] += sums[::2]


def build_model(langs: list[str], lang_at: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Model:
    """The frozen trees from counts of full-length grams (language index, gram, count)."""
    n = len(langs)
    model = Model(langs, [])
    for order in range(ORDER + 1):
        short = keys & np.uint32((1 << (8 * (order + 1))) - 1 if order < 3 else 0xFFFFFFFF)
        pairs, where = np.unique(short, return_inverse=True)
        seen = np.zeros((len(pairs), n))
        np.add.at(seen, (where, lang_at), counts)
        contexts, context_of = np.unique(pairs >> np.uint32(8), return_inverse=True)
        total, distinct = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
        np.add.at(total, context_of, seen)
        np.add.at(distinct, context_of, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            all_counts = total + distinct
            escapes = np.where(total > 0, np.log2(all_counts / distinct), 0.0)
            own = np.log2(all_counts[context_of] / seen)
        lower = model.cost(pairs & np.uint32((1 << (8 * order)) - 1), order - 1) if order else np.full(seen.shape, 8.0)
        costs = np.where(seen > 0, own, escapes[context_of] + lower)
        model.levels.append(Level(Table(contexts), escapes.astype(np.float32), Table(pairs), costs.astype(np.float32)))
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """The model of the documents that may be learned from (see the module's sample bound)."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
                          & F.col("text").rlike("\\p{L}"))
    # Only ids travel, at most ``sample_per_lang`` per language from each task.
    picked = stratified_sample(labelled.select("lang", "doc_id"), sample_per_lang, key="lang", id_col="doc_id",
                               seed="ppm:", strict=False).distinct()
    # bounded by ``sample_per_lang`` rows per language: no text is shuffled to find the sample
    sample = labelled.select("lang", "doc_id", "text").join(F.broadcast(picked), ["lang", "doc_id"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, n = np.unique(grams(np.frombuffer(normal_bytes(text), np.uint8)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)),
                     pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    summed = (sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    # the order of UTF-8 bytes is the order of code points
    langs = sorted(summed.column("lang").unique().to_pylist(), key=lambda x: x.encode("utf-8", "surrogatepass"))
    at = {lang: i for i, lang in enumerate(langs)}
    lang_at = np.array([at[x] for x in summed.column("lang").to_pylist()], np.int64)
    return build_model(langs, lang_at, summed.column("gram").to_numpy().astype(np.uint32),
                       summed.column("n").to_numpy().astype(np.float64))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) per row; score: the winner's share of the codes' probabilities."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shipped.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            told = [i for i, letter in enumerate(batch.column(2).to_pylist()) if letter and frozen.langs]
            pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if told:
                bits = frozen.bits([normal_bytes(texts[i]) for i in told])
                best = bits.argmin(axis=1)
                gap = np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
                for i, b, s in zip(told, best.tolist(), np.round(1 / gap, 6).tolist()):
                    pred[i], score[i] = frozen.langs[b], s
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    id_type = dict(docs.dtypes)["doc_id"]
    told = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", told.alias("_l_letter")).mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double")


def identify(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): train on the learnable documents, predict all."""
    model = train(docs, sample_per_lang)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
