"""Conversation structure repair: cheapest edits, least audit, by prefix-doubling path ranking (operator 13).

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``.  ``repair`` finds the
cheapest edits that make it so: Keep a row (0), Rerole it to user or assistant (3), Delete it (4, the
only choice for blank and duplicate rows), Insert an empty row of either role anywhere (3); a
truncated row that isn't deleted costs 3 more.  Its audit is the initials of the edits in order; of
all cheapest audits the one that comes first in ASCII order counts.

Method.  A node is a place between two rows and the state of what has been given out so far
(nothing, s, u, a); edits are arcs.

1. Cost DP: rows are sorted and cut into blocks of at most ``BLOCK`` rows of one conversation.  A
   block is a 4 x 4 matrix over (min, +); where a conversation has several blocks, the costs from
   each block's end to the conversation's end come from doubling matrices along the chain of blocks.
2. Within a block, only arcs of cheapest paths remain.  ``least_paths`` ranks their nodes by the
   first 1, 2, 4, 8 … letters of their least audits: the rank by 2n letters is the rank by n letters,
   then that of the nodes reached by them.  The final ranks choose one arc per node.
3. The chosen arcs are pointers.  Doubled pointers collect the path from each possible entry state of
   a block, its letters and the state in which it leaves.  (A letter and a state fix the next state,
   so equal audits are equal paths, and no tie reaches beyond a block.)  Doubling those states along
   the chain of blocks says which entry state of each block counts.

Scale: no conversation is gathered.  Rows are range-partitioned by (conversation, turn, …), so one that
holds a third of all rows lies in many partitions and blocks; a block's task holds two bytes a row, and
chains take a number of rounds that grows with the logarithm of their blocks.  Every join is on a row
or block number, which is unique.  First occurrences (duplicates) are partial minima per conversation,
role and SHA-256 of the text.  Only the digest of a repaired conversation is sequential, as SHA-256
is: ``digests`` streams each conversation's rows in order through one hash object and holds none.

Defined cases: a NULL role or text counts as one space; rows of a NULL conversation id are one
conversation; NULL turns come first; rows of equal turns are taken by role, then by SHA-256 of the text
(equal rows are interchangeable); an empty role counts as one space; initials are case-sensitive; an
empty table gives no rows; very long texts are hashed whole, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.order import dense_positions, sorted_ids
from kestrel.session import Held, owned

BLOCK = 1024                 # rows of a block at most
CHUNK = 1 << 14              # rows ranked at once within a task
SPACES = " \t\n\x0b\x0c\r"
FAR = 1 << 60                # cost of what is impossible

# States, and what an inserted or changed row adds in each: u, u, a, u.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
END = "\0"                   # letter of a path that has ended


# --- rows -------------------------------------------------------------------------------------

def _space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows changed by ``crc32(conv_id:turn) % 20``.

    0 drops the row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats it, 4
    sets its role to user.  NULLs count as one space.
    """
    kind = F.crc32(F.concat(_space(F.col("conv_id")), F.lit(":"), _space(F.col("turn"))).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _space(F.col("role")).alias("role"), _space(F.col("text")).alias("text"),
                        kind.alias("kind")).where(F.col("kind") != 0)
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop(
        "copy")


def _ordered(turns: DataFrame, held: Held) -> DataFrame:
    """Checkpointed rows (conv, turn, role, text, digest, pos): ``pos`` counts the rows in order."""
    role, text = _space(F.col("role")), _space(F.col("text"))
    rows = turns.select(F.col("conv_id").alias("conv"), "turn", F.when(role == "", " ").otherwise(role).alias("role"),
                        text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
                        # parts equal rows, however many there are, over the partitions
                        F.monotonically_increasing_id().alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "tie")]
    return sorted_ids(rows, *order, name="pos", held=held).drop("tie")


def _marked(rows: DataFrame) -> DataFrame:
    """(conv, turn, pos, initial, fault): fault is b(lank), d(uplicate), t(runcated) or -."""
    first = rows.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    seen = rows.select("conv", "turn", "pos", F.substring("role", 1, 1).alias("initial"), F.substring(shown, -1, 1).alias("last"))
    fault = (F.when(F.col("last") == "", "b").when(F.col("new").isNull(), "d")
             .when(F.col("last").isin(".", "!", "?"), "-").otherwise("t"))
    return seen.join(first, "pos", "left").select("conv", "turn", "pos", "initial", fault.alias("fault"))


def _blocks(marks: DataFrame) -> DataFrame:
    """(conv, start, end, initials, faults): one letter a row, at most ``BLOCK`` rows."""
    part = F.shiftright("pos", BLOCK.bit_length() - 1)
    got = marks.groupBy("conv", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows"))
    return got.select("conv", F.col("rows")[0]["pos"].alias("start"), (F.col("rows")[0]["pos"] + F.size("rows")).alias("end"),
                      F.array_join("rows.initial", "").alias("initials"), F.array_join("rows.fault", "").alias("faults"))


def _linked(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the start of the conversation's previous and next block (NULL: none) and
    ``seam``, the first initial of the next."""
    following = blocks.select(F.col("conv").alias("c"), F.col("start").alias("end"), F.col("start").alias("next"),
                              F.substring("initials", 1, 1).alias("seam"))
    ahead = blocks.join(following, "end", "left")
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("next").isNotNull()
    ahead = ahead.select("conv", "start", "end", "initials", "faults", F.when(same, F.col("next")).alias("next"),
                         F.when(same, F.col("seam")).alias("seam"))
    before = ahead.where(F.col("next").isNotNull()).select(F.col("next").alias("start"), F.col("start").alias("previous"))
    return ahead.join(before, "start", "left")


# --- costs ------------------------------------------------------------------------------------

def _moves(initial: str, fault: str) -> list[list[tuple[str, int, int]]]:
    """Per state: (letter, cost, next state) of the edits that use up a row."""
    out = []
    for state in range(STATES):
        arcs = [("D", DELETE_COST, state)]
        if fault in "-t":
            more = TRUNCATED_COST if fault == "t" else 0
            arcs.append(("R", REROLE_COST + more, NEXT[state]))
            if initial == "s" and state == NOTHING:
                arcs.append(("K", KEEP_COST + more, SYSTEM))
            elif initial == "ua"[NEXT[state] == ASSISTANT]:
                arcs.append(("K", KEEP_COST + more, NEXT[state]))
        out.append(arcs)
    return out


class Moves(dict):
    """``_moves`` by (initial, fault)."""

    def __missing__(self, key: tuple[str, str]):
        self[key] = found = _moves(*key)
        return found


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs to the end with Inserts allowed first; two in a row are the most that can pay."""
    once = [min(costs[s], INSERT_COST + costs[NEXT[s]]) for s in range(STATES)]
    return [min(once[s], INSERT_COST + once[NEXT[s]], FAR) for s in range(STATES)]


ENDED = _with_inserts([0, FAR, FAR, 0])  # to the end of the conversation, after its last row


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(start, initials, faults) -> (start, m): m[4 i + j] is the least cost from state i to state j
    over the block's rows."""
    moves = Moves()
    for batch in batches:
        matrices = []
        for initials, faults in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rows = [moves[k] for k in zip(initials, faults)]
            columns = []
            for j in range(STATES):
                costs = [FAR] * STATES
                costs[j] = 0
                for row in reversed(rows):
                    costs = _with_inserts([min(cost + costs[to] for _, cost, to in arcs) for arcs in row])
                columns.append(costs)
            matrices.append([columns[j][i] for i in range(STATES) for j in range(STATES)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(matrices, pa.list_(pa.int64()))], ["start", "m"])


def _doubled(chain: DataFrame, to: str, value: str, combine: str, held: Held) -> DataFrame:
    """``chain`` (start, ``to``, ``value``) with ``value`` combined along the pointers ``to`` to their end.

    ``combine`` is SQL over ``value`` (near) and ``far``.  Every round doubles the reach and is
    written to the checkpoint folder; the pointer of the result names the last block met.
    """
    current = held.checkpoint(chain.select("start", F.col(to).alias("to"), F.col(to).alias("last"), value))
    while not current.where(F.col("to").isNotNull()).isEmpty():
        ahead = current.select(F.col("start").alias("to"), F.col("to").alias("further"), F.col("last").alias("end"),
                               F.col(value).alias("far"))
        step = current.join(ahead, "to", "left").select(
            "start", F.col("further").alias("to"), F.coalesce("end", "last").alias("last"),
            F.when(F.col("to").isNull(), F.col(value)).otherwise(F.expr(combine)).alias(value))
        following = held.checkpoint(step)
        held.release(current)
        current = following
    return current.select("start", "last", value)


MIN_PLUS = "transform(sequence(0, 15), e -> least({0}, {1}L))".format(
    ", ".join(f"m[e div 4 * 4 + {k}] + far[{4 * k} + e % 4]" for k in range(STATES)), FAR)
COMPOSED = "transform(far, s -> state[s])"


def _costs_after(linked: DataFrame, held: Held) -> DataFrame:
    """(start, after): costs from the block's end, by state, for blocks that another one follows."""
    chained = linked.where(F.col("next").isNotNull() | F.col("previous").isNotNull())
    matrices = chained.select("start", "initials", "faults").mapInArrow(_matrices, "start long, m array<long>")
    whole = _doubled(chained.select("start", "next").join(matrices, "start"), "next", "m", MIN_PLUS, held)
    ended = "array(" + ", ".join(f"{c}L" for c in ENDED) + ")"
    vector = F.expr(f"transform(sequence(0, 3), i -> array_min(transform({ended}, (c, j) -> least(m[4 * i + j] + c, {FAR}L))))")
    return chained.where(F.col("next").isNotNull()).select("start", "next").join(
        whole.select(F.col("start").alias("next"), vector.alias("after")), "next").select("start", "after")


# --- paths ------------------------------------------------------------------------------------

def _least(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Smallest of ``values`` per group number below ``n``."""
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, groups, values)
    return out


def least_paths(n: int, tail: np.ndarray, letter: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(head, letter) of the arc that the least label sequence takes from each of ``n`` nodes.

    The arcs form a DAG but for the sinks' arcs to themselves, which alone have letter 0; every node
    has an arc.  ``rank`` orders the nodes by the first ``length`` letters of their least sequences,
    ``source`` -> ``reached`` holds the nodes that those letters may lead to.  A round doubles the length.
    """
    rank = _least(tail, letter, n)
    kept = letter == rank[tail]
    source, reached = tail[kept], head[kept]
    sink = np.zeros(n, bool)
    sink[tail[letter == 0]] = True
    while True:
        best = _least(source, rank[reached], n)
        on = rank[reached] == best[source]
        source, reached = source[on], reached[on]
        _, rank = np.unique(rank * (n + letter.max() + 1) + best, return_inverse=True)
        if sink[reached].all():
            break
        by = np.argsort(source, kind="stable")
        source, reached = source[by], reached[by]
        first = np.searchsorted(source, np.arange(n + 1))
        count = (first[1:] - first[:-1])[reached]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        both = np.unique(np.repeat(source, count) * n + reached[np.repeat(first[reached], count) + place])
        source, reached = both // n, both % n
    by = np.lexsort((rank[head], letter, tail))
    chosen = by[np.searchsorted(tail[by], np.arange(n))]
    return head[chosen], letter[chosen]


def walk(pointer: np.ndarray, letter: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Letters of the path from each start, and the sink where it ends, by doubling pointers."""
    jumps = [pointer]
    while (jumps[-1] != jumps[-1][jumps[-1]]).any():
        jumps.append(jumps[-1][jumps[-1]])
    node, path, step = starts, np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for k in range(len(jumps) - 1, -1, -1):
        live = letter[node] > 0
        node, path, step = node[live], path[live], step[live]
        node, path, step = (np.concatenate([node, jumps[k][node]]), np.concatenate([path, path]),
                            np.concatenate([step, step + (1 << k)]))
    live = letter[node] > 0
    node, path, step = node[live], path[live], step[live]
    by = np.lexsort((step, path))
    letters, ends = letter[node[by]].astype(np.uint8), np.searchsorted(path[by], np.arange(len(starts) + 1))
    return [letters[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], jumps[-1][starts]


def _audits(blocks: list[tuple]) -> list[tuple[list[int], list[str], list[int]]]:
    """Per block (initials, faults, costs after it or None, whether it is a conversation's first): the
    leaving state, audit and cost by entry state."""
    moves = Moves()
    tail, letter, head, starts, costs_in, sinks = [], [], [], [], [], {}
    n = 0

    def arc(a: int, x: str, b: int) -> None:
        tail.append(a)
        letter.append(ord(x))
        head.append(b)

    for initials, faults, after, first in blocks:
        size = len(initials)
        costs = ENDED if after is None else list(after)
        base, last = n, n + STATES * size  # node of row i in state s: base + STATES * i + s
        n = last + STATES
        if after is None:  # the conversation's end is a node of its own; Inserts may come before it
            sinks[n] = 0
            arc(n, END, n)
            for s in range(STATES):
                if s in (NOTHING, ASSISTANT):
                    arc(last + s, END, n)
                elif costs[s] == INSERT_COST + costs[NEXT[s]]:
                    arc(last + s, "I", last + NEXT[s])
            n += 1
        else:
            for s in range(STATES):
                sinks[last + s] = s
                arc(last + s, END, last + s)
        for i in range(size - 1, -1, -1):
            row, here, there = moves[initials[i], faults[i]], base + STATES * i, base + STATES * (i + 1)
            now = _with_inserts([min(cost + costs[to] for _, cost, to in arcs) for arcs in row])
            for s in range(STATES):
                for x, cost, to in row[s]:
                    if now[s] == cost + costs[to]:
                        arc(here + s, x, there + to)
                if now[s] == INSERT_COST + now[NEXT[s]]:
                    arc(here + s, "I", here + NEXT[s])
            costs = now
        entries = 1 if first else STATES
        starts.append([base + s for s in range(entries)])
        costs_in.append(costs[:entries])
    pointer, letters = least_paths(n, np.array(tail), np.array(letter, np.int64), np.array(head))
    paths, ends = walk(pointer, letters, np.array([s for some in starts for s in some]))
    out, at = [], 0
    for some, costs in zip(starts, costs_in):
        mine = range(at, at + len(some))
        out.append(([sinks[int(ends[k])] for k in mine], [paths[k].decode("ascii") for k in mine], costs))
        at += len(some)
    return out


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(start, initials, faults, after, first) -> (start, leaving, audits, costs), by entry state."""
    def result(starts, blocks):
        found = _audits(blocks)
        return pa.RecordBatch.from_arrays(
            [pa.array(starts, pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int32())),
             pa.array([f[1] for f in found], pa.list_(pa.string())), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
            ["start", "leaving", "audits", "costs"])

    for batch in batches:
        starts, blocks, size = [], [], 0
        for start, *block in zip(*(batch.column(i).to_pylist() for i in range(5))):
            starts.append(start)
            blocks.append(tuple(block))
            size += len(block[0])
            if size >= CHUNK:
                yield result(starts, blocks)
                starts, blocks, size = [], [], 0
        if blocks:
            yield result(starts, blocks)


CHOICES = "start long, leaving array<int>, audits array<string>, costs array<long>"


def _entries(linked: DataFrame, choices: DataFrame, held: Held) -> DataFrame:
    """(start, head, entry) of every block: the conversation's first block, and the state at entry."""
    onward = linked.select("start", "previous").join(
        choices.select(F.col("start").alias("previous"), F.col("leaving").alias("state")), "previous").select(
        "start", "previous", "state")
    heads = linked.where(F.col("previous").isNull() & F.col("next").isNotNull()).select(
        "start", F.lit(None).cast("long").alias("previous"), F.array(F.lit(NOTHING)).alias("state"))
    whole = _doubled(onward.unionByName(heads), "previous", "state", COMPOSED, held)
    return linked.select("start").join(whole, "start", "left").select(
        "start", F.coalesce("last", "start").alias("head"), F.coalesce(F.col("state")[0], F.lit(NOTHING)).alias("entry"))


# --- results ----------------------------------------------------------------------------------

EDITS = "head long, pos long, before string, edit string, role string, after string"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, start, initials, entry, audit) -> one row per row of the block: its edit (K, R or D), the new
    role of R, and the initials of what is inserted before it and, at the very end, after it."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for head, start, initials, state, audit in zip(*(batch.column(i).to_pylist() for i in range(5))):
            row, inserted, kept = 0, "", audit.rstrip("I")
            for x in kept:
                if x == "I":
                    state = NEXT[state]
                    inserted += ROLE[state][0]
                    continue
                if x != "D":
                    state = SYSTEM if x == "K" and state == NOTHING and initials[row] == "s" else NEXT[state]
                for column, value in zip(out, (head, start + row, inserted, x, ROLE[state] if x == "R" else None, "")):
                    column.append(value)
                row, inserted = row + 1, ""
            for _ in audit[len(kept):]:
                state = NEXT[state]
                out[5][-1] += ROLE[state][0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if i < 2 else pa.string()) for i, c in enumerate(out)],
            ["head", "pos", "before", "edit", "role", "after"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (head, line) rows -> (head, sha256 of the newline-joined lines), one row at a time."""
    current, digest = None, None
    for batch in batches:
        heads, digests = [], []
        for head, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if head != current:
                if current is not None:
                    heads.append(current)
                    digests.append(digest.hexdigest())
                current, digest = head, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(digests, pa.string())], ["head", "sha256"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], ["head", "sha256"])


@dataclass
class Repair:
    """What ``repair`` found; every frame is read from checkpointed tables until ``held`` is closed."""

    rows: DataFrame      # conv, turn, role, text, digest, pos
    marks: DataFrame     # conv, turn, pos, initial, fault
    blocks: DataFrame    # conv, start, initials, seam, head, entry, audit, cost
    held: Held           # owns the tables that these read

    def edits(self) -> DataFrame:
        """One row per input row, ``EDITS``; ``head`` numbers the conversation, ``pos`` the row."""
        return self.blocks.select("head", "start", "initials", "entry", "audit").mapInArrow(_edits, EDITS)

    def repaired(self) -> DataFrame:
        """Rows of the repaired conversations: (conv_id, head, pos, k, edit, role, text), ordered by (pos, k)."""
        def inserted(initials: str) -> Column:
            return F.transform(F.filter(F.split(initials, ""), lambda c: c != ""), lambda c: F.struct(
                F.lit("I").alias("edit"), F.when(c == "u", "user").otherwise("assistant").alias("role"),
                F.lit("").alias("text")))

        edits = self.edits().withColumnRenamed("role", "to")
        row = self.rows.select(F.col("conv").alias("conv_id"), "pos", "role", "text").join(edits, "pos")
        own = F.array(F.struct(F.col("edit"), F.coalesce("to", "role").alias("role"), F.col("text")))
        kept = F.when(F.col("edit") != "D", own).otherwise(F.slice(own, 1, 0))
        return row.select("conv_id", "head", "pos", F.posexplode(F.concat(inserted("before"), kept, inserted("after"))).alias(
            "k", "row")).select("conv_id", "head", "pos", "k", "row.*")

    def digests(self) -> DataFrame:
        """(head, sha256) of each conversation that keeps a row: its ``role:text`` lines, newline-joined."""
        lines = self.repaired().select("head", "pos", "k", F.concat("role", F.lit(":"), "text").alias("line"))
        ordered = lines.repartition("head").sortWithinPartitions("pos", "k").select("head", "line")
        return ordered.mapInArrow(_hashes, "head long, sha256 string")

    def summary(self) -> DataFrame:
        """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        def count(fault: str) -> Column:
            return F.count_if(F.col("fault") == fault)

        gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
        faults = self.marks.groupBy("conv").agg(
            F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), count("b").alias("blank"),
            count("d").alias("duplicate"), count("t").alias("truncated"))
        pairs = "filter(sequence(1, length(initials) - 1), i -> substring(initials, i, 2) NOT IN ('su', 'ua', 'au'))"
        inside = F.when(F.length("initials") > 1, F.size(F.expr(pairs))).otherwise(0)
        seam = F.concat(F.substring("initials", -1, 1), "seam").isin("su", "ua", "au")
        across = F.when(F.col("seam").isNull() | seam, 0).otherwise(1)
        audit = F.array_join(F.sort_array(F.collect_list(F.struct("start", "audit")))["audit"], "")
        whole = self.blocks.groupBy("head").agg(
            F.first("conv").alias("conv"), F.sum(inside + across).alias("illegal"),
            F.max(F.when(F.col("start") == F.col("head"), F.col("cost"))).alias("cost"), audit.alias("audit"))
        hashed = whole.join(self.digests(), "head", "left").withColumnRenamed("conv", "c")
        empty = hashlib.sha256().hexdigest()
        return faults.join(hashed, faults["conv"].eqNullSafe(hashed["c"])).select(
            F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
            F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))


def repair(turns: DataFrame) -> Repair:
    """Cheapest edits of all conversations of (conv_id, turn, role, text)."""
    held = Held(turns.sparkSession)
    rows = dense_positions(_ordered(turns, held), "pos")
    marks = _marked(rows)
    cut = held.checkpoint(_blocks(marks))
    linked = held.checkpoint(_linked(cut))
    held.release(cut)
    blocks = linked.join(_costs_after(linked, held), "start", "left").select(
        "start", "initials", "faults", "after", F.col("previous").isNull().alias("first"))
    choices = held.checkpoint(blocks.mapInArrow(_choices, CHOICES))
    chosen = linked.join(choices, "start").join(_entries(linked, choices, held), "start").select(
        "conv", "start", "initials", "seam", "head", "entry", F.get("audits", F.col("entry")).alias("audit"),
        F.get("costs", F.col("entry")).alias("cost"))
    return Repair(rows, marks, chosen, held)


def summaries(turns: DataFrame, original: DataFrame) -> DataFrame:
    """``Repair.summary`` of ``turns`` for every conv_id of ``original``; one without rows in ``turns``
    has zeros, an empty audit and the hash of the empty string."""
    known = original.select(F.col("conv_id").alias("id")).distinct()
    repaired = repair(turns)
    found = repaired.summary()
    joined = known.join(found, known["id"].eqNullSafe(found["conv_id"]), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
             for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return owned(joined.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                               F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")), repaired.held)
