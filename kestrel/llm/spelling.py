"""Spelling variant grouping: words one edit apart, by a dictionary of trie-node pairs (operator 12).

Two words are near if they differ by exactly one inserted, deleted or replaced code point.  The
form of a word is its most frequent near word if that is at least ``ratio`` times as frequent; the
root is where following forms ends.

Method.  All distinct words go into a trie, their reversals into a second one, and the nodes of
both get integers.  A word and a place in it then make a pair (prefix node, suffix node):

* the pair *across* place i skips the code point there: prefix before i, suffix after i;
* the pair *at* gap i has nothing between prefix and suffix.

Two different words with the same pair across one place differ by that one replacement.  A word
whose pair at a gap equals another word's pair across a place is that word with one code point
less.  Numbers stand for equal strings only, so the neighbours are exact and nothing is checked
afterwards.  Of a run of equal code points only the first is skipped for deletions, so that each
two near words meet in one pair exactly once.  A pair whose prefix or suffix belongs to a single
word can have no partner and isn't made.

Numbering without a central trie: the words are range-partitioned and sorted (``order.sorted_ids``);
a task walks its words, keeps the nodes of the current word as a stack and gives a number to every
node it meets first.  A node that spans partitions is a prefix of the first word of some partition
(any word between two words with a common prefix has it too), so its number is that of the first
such partition and its depth, which each task finds by bisection among the partitions' first words:
two words a partition reach the driver and the tasks, nothing else does.

Scale: the corpus is read once and counted with partial aggregation, so frequent words are one row
per task.  A pair has at most one word at its gap and one word per letter across its place: groups are
bounded by the alphabet.  A group returns one row per word (its count and its best partner), never
the pairs.  Forms at least double the count, so roots need few rounds of pointer doubling.

Defined cases: NULL and empty texts have no words; a NULL document id is written as nothing before
the colon; very long texts are cut into words whole; a very long word costs its length, not its square;
ties between near words go to the smallest in code-point order; repeated rows count each; an empty
table or one without repeated words gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.order import PART_SHIFT, sorted_ids
from kestrel.llm.words import whole
from kestrel.session import Held, owned

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
DAMAGE = 97        # one run in so many loses a code point
SLOT_BITS = 40     # nodes per partition

NUMBERED = "id long, nodes array<long>, fresh array<boolean>"


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, run): every maximal run of letters, A-Z in lower case, one row per occurrence."""
    lowered = F.translate(whole(F.col(text)), UPPER, LOWER)
    found = F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))
    return docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("run"))


def damaged(found: DataFrame, one_in: int = DAMAGE) -> DataFrame:
    """(word): runs of ``runs``, those whose crc32 of ``doc:run`` is divisible by ``one_in`` short of
    the code point that the crc32 names."""
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    hashed = found.select("run", h.alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.overlay("run", F.lit(""), place + 1, F.lit(1))
    return hashed.select(F.when(F.col("h") % one_in == 0, shorter).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if a == b:
        return len(a)
    n = 0
    for x, y in zip(a, b):
        if x != y:
            return n
        n += 1
    return n


class TrieNumbers:
    """Numbers of the trie nodes of one partition's sorted words, consistent with all others'.

    ``firsts`` and ``lasts`` are the first and last words of the partitions that have any, in order,
    and ``parts`` their indexes.
    """

    def __init__(self, parts: list[int], firsts: list[str], lasts: list[str]):
        self.parts, self.firsts, self.lasts = parts, firsts, lasts

    def _spanning(self, word: str, depth: int) -> int:
        """Number of the prefix of ``depth`` code points of a partition's first word ``word``."""
        return bisect_left(self.firsts, word[:depth]) << SLOT_BITS | depth

    def number(self, part: int, words: Iterator[str]) -> Iterator[list[int]]:
        """Nodes of each word from the root to the deepest one that another word shares."""
        q = bisect_left(self.parts, part)
        after = self.firsts[q + 1] if q + 1 < len(self.firsts) else None
        before = self.lasts[q - 1] if q else None
        slot = len(self.firsts[q]) + 1 | q << SLOT_BITS
        nodes: list[int] = []
        word = next(words, None)
        if word is not None:
            nodes = [self._spanning(word, d) for d in range(len(word) + 1)]
        shared = _common(before, word) if before is not None and word is not None else 0
        while word is not None:
            following = next(words, None)
            beside = after if following is None else following
            common = _common(word, beside) if beside is not None else 0
            yield nodes[:max(shared, common) + 1]
            if following is not None:
                del nodes[common + 1:]
                spanning = _common(following, after) if after is not None else 0
                for d in range(common + 1, len(following) + 1):
                    if d <= spanning:
                        nodes.append(self._spanning(following, d))
                    else:
                        nodes.append(slot)
                        slot += 1
            word, shared = following, common

    def tasks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, place, word) rows of one partition -> ``NUMBERED``.

        ``id`` names the row, ``place`` is its ``sorted_ids`` number.  Words are read one batch ahead of
        what is returned.
        """
        ids: list[int] = []
        seen: list[str] = []

        def stream(first: pa.RecordBatch) -> Iterator[str]:
            batch: pa.RecordBatch | None = first
            while batch is not None:
                ids.extend(batch.column(0).to_pylist())
                for word in batch.column(2).to_pylist():
                    seen.append(word)
                    yield word
                batch = next(filled, None)

        filled = (b for b in batches if b.num_rows)
        first = next(filled, None)
        if first is None:
            return
        part = first.column(1)[0].as_py() >> PART_SHIFT
        nodes: list[list[int]] = []
        done = 0

        def batch_of() -> pa.RecordBatch:
            nonlocal done
            some = len(nodes)
            fresh = [[i == 0 or w[i] != w[i - 1] for i in range(min(len(ns), len(w)))]
                     for w, ns in zip(seen[:some], nodes)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids[:some], pa.int64()), pa.array(nodes, pa.list_(pa.int64())),
                 pa.array(fresh, pa.list_(pa.bool_()))], ["id", "nodes", "fresh"])
            del ids[:some], seen[:some]
            nodes.clear()
            return out

        for found in self.number(part, stream(first)):
            nodes.append(found)
            done += len(found)
            if len(nodes) >= 10000 or done >= 1 << 18:
                done = 0
                yield batch_of()
        if nodes:
            yield batch_of()


def number_trie(words: DataFrame, id_col: str, place: str, word: str) -> DataFrame:
    """``NUMBERED`` rows of distinct words sorted by ``sorted_ids`` (whose number is ``place``).

    ``nodes`` holds the word's trie nodes from the root down to the deepest one that another word
    shares; ``fresh`` says of each code point up to there whether it differs from the one before.
    """
    part = F.shiftrightunsigned(place, PART_SHIFT)
    ends = sorted(tuple(r) for r in words.groupBy(part.alias("p")).agg(
        F.min(word).alias("a"), F.max(word).alias("b")).collect())  # one row a partition
    numbers = TrieNumbers([e[0] for e in ends], [e[1] for e in ends], [e[2] for e in ends])
    return words.select(F.col(id_col).alias("id"), F.col(place).alias("place"), F.col(word).alias("word")).mapInArrow(
        numbers.tasks, NUMBERED)


def _pairs(vocabulary: DataFrame, forward: DataFrame, backward: DataFrame) -> DataFrame:
    """(p, s, across, fresh, rank): every pair of a word that another word can share.

    ``rank`` orders words by falling count and then code points.
    """
    joined = (vocabulary.select("id", "n", F.length("word").alias("len"))
              .join(forward.select("id", F.col("nodes").alias("fw"), "fresh"), "id")
              .join(backward.select("id", F.col("nodes").alias("bw")), "id")
              .withColumns({"f": F.size("fw") - 1, "b": F.size("bw") - 1}))

    def pairs(across: bool) -> str:
        rest = "len - 1" if across else "len"
        low, high = f"greatest(0, {rest} - b)", f"least(f, {rest})"
        fresh = "fresh[i]" if across else "true"
        return (f"IF({low} <= {high}, transform(sequence({low}, {high}), i -> named_struct('p', fw[i], 's', bw[{rest} - i], "
                f"'across', {across}, 'fresh', {fresh})), array())")

    rank = F.struct((-F.col("n")).alias("k"), "id").alias("rank")
    both = joined.select(rank, F.expr(f"inline(concat({pairs(True)}, {pairs(False)}))"))
    return both.select("p", "s", "across", "fresh", "rank")


def _near(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): number of near words, and rank of the first of them."""
    skipping = F.when(F.col("across"), F.struct("rank", "fresh"))
    groups = pairs.groupBy("p", "s").agg(
        F.sort_array(F.collect_list(skipping)).alias("skips"),  # at most one word per letter
        F.max(F.when(~F.col("across"), F.col("rank"))).alias("base"))  # at most one word
    groups = groups.where(F.size("skips") + F.col("base").isNotNull().cast("int") >= 2)
    groups = groups.withColumn("longer", F.filter("skips", lambda m: m["fresh"]))
    others = ("transform(skips, m -> named_struct('id', m.rank.id, "
              "'c', CAST(size(skips) - 1 + IF(m.fresh AND base IS NOT NULL, 1, 0) AS BIGINT), "
              "'best', least(get(skips, IF(skips[0].rank.id = m.rank.id, 1, 0)).rank, IF(m.fresh, base, NULL))))")
    shorter = ("IF(base IS NOT NULL AND size(longer) > 0, array(named_struct('id', base.id, "
               "'c', CAST(size(longer) AS BIGINT), 'best', longer[0].rank)), array())")
    each = groups.select(F.expr(f"inline(concat({others}, {shorter}))")).where(F.col("c") > 0)
    return each.groupBy("id").agg(F.sum("c").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, held: Held) -> DataFrame:
    """(id, root) by pointer doubling over (id, up).

    Each step of a chain at least doubles the count, so there are few rounds.
    """
    current = held.checkpoint(forms.select("id", F.col("up").alias("root")))
    while True:
        above = current.select(F.col("id").alias("root"), F.col("root").alias("higher"))
        moved = held.checkpoint(current.join(above, "root", "left").select(
            "id", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")))
        held.release(current)
        current = moved
        if moved.where("moved").isEmpty():
            return current.select("id", "root")


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for each of the distinct words (word, n).

    The result owns the tables that it reads (``session.close_result`` deletes them).
    """
    held = Held(counts.sparkSession)
    vocabulary = sorted_ids(counts.select("word", "n"), "word", held=held)
    turned = sorted_ids(vocabulary.select("id", F.reverse("word").alias("turned")), "turned", name="place", held=held)
    pairs = _pairs(vocabulary, number_trie(vocabulary, "id", "id", "word"), number_trie(turned, "id", "place", "turned"))
    near = held.checkpoint(_near(pairs))
    held.release(turned)
    known = vocabulary.join(near, "id", "left")
    enough = -F.col("best.k") >= F.col("n") * ratio
    known = known.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                         F.when(enough, F.col("best.id")).alias("up"))
    names = vocabulary.select(F.col("id").alias("up"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    roots = _roots(known.where(F.col("up").isNotNull()).select("id", "up"), held)
    root_names = vocabulary.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    return owned(known.join(names, "up", "left").join(roots.withColumnRenamed("root", "root_id"), "id", "left")
            .join(root_names, "root_id", "left")
            .select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"), held)
