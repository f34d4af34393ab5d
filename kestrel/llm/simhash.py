"""SimHash near-duplicates with pigeonring filtering (operator 6).

A fingerprint has 64 bits over word shingles; two fingerprints link at ``max_distance`` or fewer
differing bits, and linked documents form components.

Candidates come from the pigeonring principle.  The bits are cut into ``segments`` arranged in a
ring.  If two fingerprints differ in at most d bits, some segment starts a chain in which every
prefix of l segments holds at most floor(l * d / segments) differing bits.  The leading segments
whose budget is zero must be equal, which is an equi-key: every fingerprint is indexed once per
starting segment under those leading bits.  The next budget is one bit, so of the ``extra`` segments behind
them at most one differs: the key goes on with all of them but one, once for each.  Keys of 16 segments have
20 + 4 (extra - 1) bits in 16 * extra rows a fingerprint.  The later budgets prune a pair before its full
Hamming distance is computed.  The principle loses no pair within the distance.

Scale: copies share a fingerprint, so all later work runs on distinct fingerprints.  A key with
more than ``block`` fingerprints is cut into blocks, and every pair of blocks is a group of its
own, so no task holds more than 2 * ``block`` fingerprints of a key.  A group emits the edges of
a spanning forest of its links, not all pairs; components need no more.  Components are found by
``graph.connected_components``.  Nothing is collected to the driver.

Defined cases: NULL or blank text has fingerprint 0, linked like any other; fewer words than a
shingle give one shingle of the whole sequence; rows with the same id are separate documents with
one id; a NULL id never names a component unless all of its members have none (then NULL); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.graph import connected_components
from kestrel.llm.words import packed, row_key
from kestrel.session import Held, owned, pass_on

SEED = 42        # of XXH64
BITS = 64
SHINGLE = 3      # words
MAX_DISTANCE = 3
SEGMENTS = 16
BLOCK = 1024
EXTRA = 3        # segments that lengthen the key; one more for 16 times as many fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash

    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules
    if not ws:
        return 0
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    count = len(ws) - shingle + 1
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(
        begins[:count].tolist(), ends[shingle - 1:].tolist())), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, count, 1 << 16):  # bounds the unpacked bits of a very long text
        part = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col("text")).mapInArrow(run, f"id {kind}, fp long")


def ring_budgets(segments: int, max_distance: int) -> tuple[int, list[tuple[int, int]]]:
    """Leading bits that must be equal, and (prefix bits, most differing bits) of longer chains.

    Only the longest chain of each budget is kept: it implies the shorter ones.
    """
    width = BITS // segments
    budget = {}
    for chain in range(1, segments + 1):
        budget[chain * max_distance // segments] = chain * width
    return budget.pop(0, 0), sorted((bits, most) for most, bits in budget.items())


def _spanning_links(x: np.ndarray, part: np.ndarray, checks: list[tuple[int, int]],
                    between: bool) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the linked pairs of one group.

    ``x``: fingerprints rotated so that the chain's first segment leads; ``part``: their block;
    ``between``: only pairs of different blocks.
    """
    n = len(x)
    if n == 2:
        d = int(x[0]) ^ int(x[1])
        linked = all((d >> (BITS - bits)).bit_count() <= most for bits, most in checks)
        return [(0, 1)] if linked and (not between or part[0] != part[1]) else []
    adj = np.ones((n, n), bool)
    diff = x[:, None] ^ x[None, :]
    for bits, most in checks:  # each budget prunes the pairs that the next one looks at
        rows, cols = np.nonzero(adj)
        adj[rows, cols] = np.bitwise_count(diff[rows, cols] >> np.uint64(BITS - bits)) <= most
    if between:
        adj &= part[:, None] != part[None, :]
    fresh, out = np.ones(n, bool), []
    for seed in range(n):
        if not fresh[seed]:
            continue
        fresh[seed] = False
        queue = [seed]
        while queue:
            i = queue.pop()
            found = np.flatnonzero(adj[i] & fresh)
            fresh[found] = False
            out.extend((i, j) for j in found.tolist())
            queue.extend(found.tolist())
    return out


def extra_segments(segments: int, max_distance: int) -> int:
    """How many segments after the equal ones may hold one differing bit in all."""
    return (2 * segments - 1) // max_distance - (segments - 1) // max_distance


def fingerprint_links(fps: DataFrame, segments: int = SEGMENTS, max_distance: int = MAX_DISTANCE,
                      block: int = BLOCK, extra: int = EXTRA) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all links.

    ``fps``: one column ``fp`` of distinct signed fingerprints.  ``extra`` of the segments behind the
    equal ones lengthen the key: at most one of them differs, so a fingerprint is indexed once without each.
    """
    if BITS % segments or not 0 < max_distance < segments:
        raise ValueError("segments must divide 64 and exceed max_distance")
    if extra == 1 or not 0 <= extra <= extra_segments(segments, max_distance):
        raise ValueError(f"extra must be 0 or 2 to {extra_segments(segments, max_distance)} segments")
    width = BITS // segments
    lead, checks = ring_budgets(segments, max_distance)
    spun = F.expr(f"shiftleft(fp, int(turn * {width})) | shiftrightunsigned(fp, int(64 - turn * {width}))")
    index = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("turn"))
    index = index.select("fp", "turn", spun.alias("x"))
    # the leading bits, those of the extra segments but one, that one and the starting segment, as one number
    code = F.expr(f"shiftrightunsigned(x, {BITS - lead})")
    index = index.withColumn("without", F.explode(F.sequence(F.lit(0), F.lit(max(extra, 1) - 1))))
    for e in range(extra):
        bits = F.expr(f"shiftrightunsigned(x, {BITS - lead - (e + 1) * width}) & {(1 << width) - 1}L")
        code = code * (1 << width) + F.when(F.col("without") != e, bits).otherwise(0)
    code = (code * max(extra, 1) + F.col("without")) * segments + F.col("turn")
    index = index.select("fp", "turn", "x", code.alias("k"))
    hot = index.groupBy("k").count().where(F.col("count") > block).select(
        "k", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    index = index.join(hot, "k", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    index = index.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = index.select("k", "turn", "x", "part", F.explode(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
            F.least("part", other).alias("low"), F.greatest("part", other).alias("high")))).alias("duel"))
    dealt = dealt.select("k", "duel.low", "duel.high", "part", "x", "turn")
    dealt = dealt.repartition("k", "low", "high").sortWithinPartitions("k", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(cols: list[np.ndarray], upto: int, cuts: np.ndarray) -> pa.RecordBatch:
            k, low, high, part, x, turn = cols
            found_a, found_b = [], []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if j - i < 2 or j > upto:
                    continue
                own = x[i:j]
                edges = _spanning_links(own, part[i:j], checks, bool(low[i] != high[i]))
                if edges:
                    s = int(turn[i]) * width
                    own = (own >> np.uint64(s)) | (own << np.uint64((BITS - s) % BITS)) if s else own
                    at = np.array(edges)
                    found_a.append(own[at[:, 0]])
                    found_b.append(own[at[:, 1]])
            none = np.zeros(0, np.uint64)
            a, b = np.concatenate([none, *found_a]), np.concatenate([none, *found_b])
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[4] = cols[4].astype(np.int64).view(np.uint64)
            if rest is not None:
                cols = [np.concatenate(pair) for pair in zip(rest, cols)]
            if not len(cols[0]):
                continue
            change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            cuts = np.concatenate(([0], change, [len(cols[0])]))
            last = int(cuts[-2])  # the last group may go on in the next batch
            yield links(cols, last, cuts[:-1])
            rest = [c[last:] for c in cols]
        if rest is not None:
            n = len(rest[0])
            yield links(rest, n, np.array([0, n]))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE,
                    max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS, block: int = BLOCK,
                    extra: int = EXTRA) -> DataFrame:
    """(id_col, fp, component_id) per row: the smallest id that its fingerprint links reach.

    The result owns the tables that it reads (``session.close_result`` deletes them).
    """
    held = Held(docs.sparkSession)
    rows = held.checkpoint(fingerprints(docs, id_col, shingle))
    fps = held.checkpoint(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = connected_components(fingerprint_links(fps.select("fp"), segments, max_distance, block, extra), held=held)
    member = fps.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "first")
    least = member.groupBy("root").agg(F.min("first").alias("least"))
    merged = member.join(least, "root").select("fp", "least")
    # Written before the join with all rows: with a plain exchange on either side Spark can split
    # the rows of a fingerprint that very many copies share.
    named = held.checkpoint(
        fps.join(merged, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")))
    held.release(fps)
    held.release(roots)
    return owned(rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id"), held)


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (NULL last).

    Rows that share a doc_id are told apart by their text; rows equal in both count as one.
    """
    order = F.coalesce(F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)"))
                              .cast("string"), 21, "0"), F.lit("~"))
    rows = packed(docs, "doc_id", "text")
    keyed = rows.select("row", "text", F.concat(order, F.hex(row_key(F.col("doc_id"), F.col("text")))).alias("s_id"))
    groups = near_duplicates(keyed.select("s_id", "text"), "s_id", shingle, max_distance)
    stay = groups.where(F.col("s_id") == F.col("component_id")).select("s_id").distinct()
    return pass_on(groups, keyed.select("s_id", "row").join(stay, "s_id").dropDuplicates(["s_id"]).select("row.*"))
