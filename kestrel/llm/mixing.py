"""Mixing sources to target weights (operator 1).

The words of each source, in a fixed pseudorandom document order, are packed into blocks of
``block`` words.  Output shards draw their source counts from a multinomial over the planned
slots; a source's slots, numbered through all shards, are mapped through a pseudorandom
permutation of its blocks (a new one for every pass), and blocks are joined by that index.

Targets: sources in code point order (NULL last) weigh 5, 2, 1, repeating, and share as many words
as all documents hold.  A target stops at ``MAX_PASSES`` times its source's size; the excess is
reshared by weight until none is above.  The drawn totals are settled to the planned ones: slots
that a source drew beyond its plan go to sources that drew too few, and the last slot of a source
takes only a part of its block, so every source gives its rounded target exactly and no document
is used more than ``MAX_PASSES`` times.

Scale: one pass over the text counts words; every later step moves numbers.  Prefix sums run per
(source, bucket) with ``BUCKETS`` buckets of pseudorandom content, so a source with a third of
all rows is spread over that many window groups.  Blocks are joined on (source, block), keys that
a hot source has as many of as it has words.  Source-level tables have one row per source.
The draw finds a slot's source through an equi-join on equal-width bins of the cumulative plan.
All choices are hashes of positions and ``seed``: a rerun, also of a lost task, agrees.

Defined cases: NULL text has size 0 and is taken 0 times; NULL source is a source of its own, last
in order; rows that are equal in all of doc_id, source and text are separate documents; without any
word all targets are 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.words import row_key, words
from kestrel.session import Held, owned

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK = 512            # words
SLOTS_PER_SHARD = 1024
BUCKETS = 1024         # window groups per source
BINS = 1024            # of the cumulative plan
ROUNDS = 24            # of the permutation
SEED = 17


def _swap_or_not(x: Column, n: Column, key: Column, rounds: Column) -> Column:
    """Pseudorandom permutation of 0..n-1: each round pairs x with K - x and keeps one by a coin.

    A round is its own inverse, so the reversed ``rounds`` give the inverse permutation.
    """
    def step(acc: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - acc, n)
        coin = F.pmod(F.xxhash64(key, r, F.greatest(acc, other)), F.lit(2))
        return F.when(coin == 1, other).otherwise(acc)

    return F.aggregate(rounds, x.cast("long"), step)


def block_of_slot(x: Column, n: Column, key: Column) -> Column:
    return _swap_or_not(x, n, key, F.sequence(F.lit(1), F.lit(ROUNDS)))


def slot_of_block(x: Column, n: Column, key: Column) -> Column:
    return _swap_or_not(x, n, key, F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)))


def _pass_key(number: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("skey"), number.cast("long"))


@dataclass
class Mix:
    sources: DataFrame    # one row per source: size, target, blocks, slots
    slots: DataFrame      # (shard, skey, i, block, take): which block part fills each slot
    pieces: DataFrame     # (skey, block, begin, end, word, document columns): documents in blocks
    block: int
    held: Held            # owns the tables that these read; the results hand it on

    def documents(self) -> DataFrame:
        """(doc_id, source, size, source_size, target, taken), one row per document."""
        return owned(document_counts(self), self.held)

    def texts(self, docs: DataFrame) -> DataFrame:
        """(shard, source, i, block, text): the words of every slot, in order."""
        return owned(slot_texts(self, docs), self.held)


def source_plan(rows: DataFrame, block: int = BLOCK, weights: tuple[int, ...] = WEIGHTS,
                seed: int = SEED) -> DataFrame:
    """One row per source: size, target, passes, slots and where its share of the slots starts.

    The windows without a partition run over sources, not documents.
    """
    s = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = s.withColumn("rank", F.row_number().over(named)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * MAX_PASSES).withColumn(
        "total", F.sum("source_size").over(every))
    # Sources reach their cap in the order of cap / weight; after those that do, the rest share
    # what is left by weight.
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    s = s.withColumns({
        "level": (F.col("total") - F.sum("cap").over(by_cap) + F.col("cap"))
        / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
        "place": F.row_number().over(by_cap)})
    open_at = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("place"))
    s = s.withColumn("open_at", F.min(open_at).over(every)).withColumn(
        "share", F.max(F.when(F.col("place") == F.col("open_at"), F.col("level"))).over(every))
    s = s.withColumn("target", F.when(F.col("place") >= F.col("open_at"), F.col("share") * F.col("weight"))
                     .otherwise(F.col("cap").cast("double")))
    size = F.col("source_size")
    s = s.withColumns({"blocks": F.ceil(size / block).cast("long"),
                       "goal": F.least(F.round("target").cast("long"), F.col("cap"))})
    s = s.withColumn("passes", F.expr("if(source_size = 0, 0L, goal div source_size)"))
    s = s.withColumn("rest", F.col("goal") - F.col("passes") * size)
    last = size - (F.col("blocks") - 1) * block
    s = s.withColumns({"last": last, "short": F.when(F.col("blocks") > 0, slot_of_block(
        F.col("blocks") - 1, F.col("blocks"), _pass_key(F.col("passes"), seed)))})
    # Slots of the broken pass, counting that one of its blocks may be the short last one.
    even = F.ceil(F.col("rest") / block).cast("long")
    holds = even * block - F.when(F.col("short") < even, block - F.col("last")).otherwise(0)
    s = s.withColumn("tail", F.when(F.col("rest") == 0, F.lit(0)).when(
        holds < F.col("rest"), even + 1).otherwise(even).cast("long"))
    s = s.withColumn("slots", F.col("passes") * F.col("blocks") + F.col("tail"))
    before = (F.col("tail") - 1) * block - F.when(F.col("short") < F.col("tail") - 1,
                                                  block - F.col("last")).otherwise(0)
    s = s.withColumn("cut", F.when(F.col("tail") > 0, F.col("rest") - before))
    lower = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumns({"low": F.coalesce(F.sum("slots").over(lower), F.lit(0)),
                          "all_slots": F.sum("slots").over(every)}).select(
        "skey", "source", "rank", "source_size", "target", "blocks", "passes", "last", "tail", "cut", "slots",
        "low", "all_slots")


def _draws(sources: DataFrame, slots_per_shard: int, bins: int, seed: int) -> DataFrame:
    """(shard, skey, drawn): the multinomial source counts of every shard."""
    n = sources.agg(F.max("all_slots")).first()[0] or 0  # one number of the checkpointed sources
    shards = sources.sparkSession.range(0, -(-n // slots_per_shard)).select(
        F.lit(n).cast("long").alias("n"), F.col("id").alias("shard")).repartition("shard")
    slots = shards.select("n", "shard", F.explode(F.expr(
        f"sequence(0, least({slots_per_shard}, n - shard * {slots_per_shard}) - 1)")).alias("slot"))
    slots = slots.withColumn("u", F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "shard", "slot"), F.col("n")))
    slots = slots.withColumn("bin", F.expr(f"u div ((n + {bins} - 1) div {bins})"))
    width = f"((all_slots + {bins} - 1) div {bins})"
    ranges = sources.where("slots > 0").select("skey", "low", (F.col("low") + F.col("slots")).alias("high"), F.explode(
        F.expr(f"sequence(low div {width}, (low + slots - 1) div {width})")).alias("bin"))
    # Spark takes unfolded arrays for as small as their source and would broadcast the slots
    hit = slots.hint("merge").join(ranges, "bin").where("u >= low and u < high")
    return hit.groupBy("shard", "skey").agg(F.count(F.lit(1)).alias("drawn"))


def slot_plan(sources: DataFrame, block: int = BLOCK, slots_per_shard: int = SLOTS_PER_SHARD,
              bins: int = BINS, seed: int = SEED, held: Held | None = None) -> DataFrame:
    """(shard, skey, i, block, take): every output slot, the block it holds and how many words."""
    held = held or Held(sources.sparkSession)
    drawn = held.checkpoint(_draws(sources, slots_per_shard, bins, seed))
    earlier = Window.partitionBy("skey").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard and source
    drawn = drawn.withColumn("first", F.coalesce(F.sum("drawn").over(earlier), F.lit(0)))
    got = drawn.groupBy("skey").agg(F.sum("drawn").alias("got"))
    plan = sources.join(got, "skey", "left").fillna(0, ["got"])
    lower = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumns({
        "over": F.coalesce(F.sum(F.greatest(F.col("got") - F.col("slots"), F.lit(0))).over(lower), F.lit(0)),
        "under": F.coalesce(F.sum(F.greatest(F.col("slots") - F.col("got"), F.lit(0))).over(lower), F.lit(0))})
    facts = ["skey", "blocks", "passes", "last", "tail", "cut"]
    # All that a slot needs is joined to the (shard, source) rows; they are dealt out by shard
    # before they unfold into slots, so a hot source's slots do not meet in one task.
    own = drawn.join(plan.select(*facts, "slots", "over"), "skey").repartition("shard")
    stay = own.where("first < slots").select("shard", *facts, F.explode(F.expr(
        "sequence(first, least(first + drawn, slots) - 1)")).alias("i"))
    # places beyond a source's plan, numbered, go to the missing slots of other sources
    free = own.where("first + drawn > slots").select("shard", F.explode(F.expr(
        "sequence(over + greatest(first, slots) - slots, over + first + drawn - 1 - slots)")).alias("x"))
    lacking = plan.where("got < slots").select(*facts, "got", "under", F.explode(F.expr(
        "sequence(under, under + slots - got - 1)")).alias("x"))
    moved = free.hint("merge").join(lacking, "x").select("shard", *facts, F.expr("got + x - under").alias("i"))
    slots = stay.unionByName(moved)
    slots = slots.withColumns({"pass": F.expr("i div blocks"), "j": F.expr("i % blocks")})
    slots = slots.withColumn("block", block_of_slot(F.col("j"), F.col("blocks"), _pass_key(F.col("pass"), seed)))
    holds = F.when(F.col("block") == F.col("blocks") - 1, F.col("last")).otherwise(F.lit(block))
    cut = (F.col("pass") == F.col("passes")) & (F.col("j") == F.col("tail") - 1)
    return slots.select("shard", "skey", "i", "block",
                        F.when(cut, F.least(holds, F.col("cut"))).otherwise(holds).cast("long").alias("take"))


def _placed(rows: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``rows`` plus ``at``, where a document begins in its source's stream of words."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "skey", "key"), F.lit(buckets)))
    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("held"))
    base = sums.withColumn("base", F.coalesce(F.sum("held").over(
        Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("skey", "bucket").orderBy(F.xxhash64(F.lit(seed + 1), "key"), "key")
    rows = rows.withColumns({
        "turn": F.row_number().over(inside),
        "inner": F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    return rows.join(base.select("skey", "bucket", "base"), ["skey", "bucket"]).withColumn(
        "at", F.col("base") + F.col("inner"))


def mix(docs: DataFrame, block: int = BLOCK, slots_per_shard: int = SLOTS_PER_SHARD, buckets: int = BUCKETS,
        bins: int = BINS, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> Mix:
    held = Held(docs.sparkSession)
    rows = held.checkpoint(docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("skey"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key")))
    sources = held.checkpoint(source_plan(rows, block, weights, seed))
    slots = slot_plan(sources, block, slots_per_shard, bins, seed, held)
    placed = _placed(rows, buckets, seed)
    each = F.when(F.col("size") > 0, F.expr(f"sequence(at div {block}, (at + size - 1) div {block})"))
    pieces = placed.select("doc_id", "source", "skey", "size", "key", "bucket", "turn", "at",
                           F.explode_outer(each).alias("block"))
    pieces = pieces.withColumns({
        "begin": F.greatest(F.col("at") - F.col("block") * block, F.lit(0)),
        "end": F.least(F.col("at") + F.col("size") - F.col("block") * block, F.lit(block))})
    return Mix(sources, slots, pieces.withColumn("word", F.greatest(
        F.col("block") * block - F.col("at"), F.lit(0))), block, held)


def document_counts(mixed: Mix) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words the mix takes of each document."""
    part = F.greatest(F.least(F.col("end"), F.coalesce("take", F.lit(0))) - F.col("begin"), F.lit(0))
    # partial sums per document before its blocks meet
    taken = mixed.pieces.join(mixed.slots.hint("merge"), ["skey", "block"], "left").groupBy(
        "skey", "bucket", "turn", "doc_id", "source", "size").agg(F.sum(F.coalesce(part, F.lit(0))).alias("taken"))
    return taken.join(mixed.sources.select("skey", "source_size", "target"), "skey").select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def slot_texts(mixed: Mix, docs: DataFrame) -> DataFrame:
    """(shard, source, i, block, text): the words of every slot joined by spaces."""
    texts = docs.select(row_key(F.col("doc_id"), F.col("source"), F.col("text")).alias("key"),
                        words(F.col("text")).alias("w")).dropDuplicates(["key"])
    parts = mixed.pieces.where("block is not null").join(texts, "key").select(
        "skey", "source", "block", "begin", F.slice(
            "w", (F.col("word") + 1).cast("int"), (F.col("end") - F.col("begin")).cast("int")).alias("w"))
    filled = mixed.slots.hint("merge").join(parts, ["skey", "block"]).where("begin < take").withColumn(
        "w", F.slice("w", F.lit(1), (F.col("take") - F.col("begin")).cast("int")))
    # at most ``block`` words per group
    return filled.groupBy("shard", "source", "i", "block").agg(F.array_join(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("begin", "w"))), lambda x: x["w"])), " ").alias("text"))
