"""Exact dedup of byte strings through a Burrows-Wheeler transform (operator 9).

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else goes.

Candidates: a window is anchored at the smallest hash of the ``GRAM``-byte runs inside it, and a
count-min sketch of the anchors tells which may occur twice (see ``repeats``; it loses none).  The
windows of one anchor occurrence form a segment of at most a few hundred bytes.  Segments of the
same anchor meet in one group; equal ones of a batch are settled before the shuffle.

Inside a task the distinct segments of many groups are concatenated and suffix-sorted.  The
transform then gives common prefixes by increasing value: a boundary between suffixes whose common
prefix has length l was found in round l; extending backward by one byte, the first suffix with
each preceding byte behind that boundary starts a boundary of length l + 1.  Rounds stop at
``WINDOW``: whatever is unset then has a longer common prefix, so it is a repeated window.

Scale: one shuffle of suspicious segments; texts meet their removals in one join keyed by
document.  An anchor that the sketch counts ``HOT`` times or more (a passage in very many
documents) would make a large group: its windows are keyed by their own hash instead, so that a
group holds one row per batch of equal windows.  Memory is bounded by ``PACK`` bytes of segments
one such group, and arrays for ``PIECE`` bytes of a text.

Defined cases: NULL text counts as empty (0 bytes); equal rows are separate documents, so their
windows repeat; a NULL or repeated doc_id is no special case; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.repeats import Prefix, anchors, maybe_repeated, merged_spans, mixed, repeated_cells
from kestrel.llm.words import row_key

WINDOW = 200   # bytes
GRAM = 32      # bytes
HOT = 2000     # occurrences of one anchor
PIECE = 1 << 21  # windows of a text hashed at once
PACK = 1 << 18  # bytes sorted at once
FIRST_BYTES = 7  # compared before the first doubling


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; a suffix stops at its segment's end, ties by position.

    ``ends``: the end of its segment for every position.  Only suffixes that are neither told apart
    nor used up are sorted again.
    """
    n = len(text)
    place = np.arange(n)
    left = ends - place
    key = np.zeros(n, np.int64)  # the first bytes as one number, 0 beyond the end
    padded = np.concatenate((text.astype(np.int64) + 1, np.zeros(FIRST_BYTES, np.int64)))
    for k in range(FIRST_BYTES):
        key = key * 257 + np.where(left > k, padded[k:k + n], 0)
    order = np.argsort(key)
    key = key[order]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    rank = np.empty(n, np.int64)  # the row where its group of equal prefixes begins
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    rows, width = np.arange(n), FIRST_BYTES
    while True:
        own = order[rows]
        group = rank[own]
        same = group[1:] == group[:-1]
        open_row = np.concatenate((same, [False])) | np.concatenate(([False], same))
        open_row &= left[own] >= width  # shorter ones are equal to their ends
        rows, own, group = rows[open_row], own[open_row], group[open_row]
        if not len(rows):
            return np.argsort(rank * n + place)  # what is still equal goes by position
        key = group * (n + 1) + np.where(left[own] > width, rank[np.minimum(own + width, n - 1)] + 1, 0)
        turn = np.argsort(key)
        own, key, group = own[turn], key[turn], group[turn]
        order[rows] = own
        first = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = rows[np.flatnonzero(first)[np.cumsum(first) - 1]]
        width *= 2


def bounded_prefixes(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, limit: int) -> tuple[
        np.ndarray, np.ndarray]:
    """(suffix array, lcp): common prefix of each suffix with the one before, ``limit`` where longer.

    ``begins`` and ``ends``: of its segment, for every position.  A segment's end differs from
    every byte and every other end.
    """
    n = len(text)
    order = suffix_order(text, ends)
    row = np.empty(n, np.int64)
    row[order] = np.arange(n)
    # the transform; the rows of segment starts have no preceding byte and lead nowhere
    inner = order > begins[order]
    before = np.where(inner, text[np.maximum(order - 1, 0)].astype(np.int64), -1)
    target = np.where(inner, row[np.maximum(order - 1, 0)], -1)
    by_byte = np.argsort(before, kind="stable")
    previous = np.full(n, -1, np.int64)  # the last earlier row with the same preceding byte
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    lcp = np.full(n, limit, np.int64)
    first = text[order]
    fresh = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    lcp[fresh] = 0
    # Suffixes that run into their ends: one of length l is a boundary of length l to its successor
    # at the latest; as an extension of the (empty) suffix at the end it starts at one byte.
    last = np.flatnonzero(ends[order] - order == 1)
    single = np.concatenate((last, last + 1))
    single = single[(single < n)]
    single = single[lcp[single] > 1]
    lcp[single] = 1
    bound = np.zeros(n + 1, bool)
    bound[n] = True
    for length in range(limit):
        if length == 1:
            fresh = np.flatnonzero(lcp == 1)
        if not len(fresh):
            break
        bound[fresh] = True
        marks = np.flatnonzero(bound)
        upto = marks[np.searchsorted(marks, fresh, side="right")]
        sizes = upto - fresh
        # all rows from each new boundary to the next one
        rows = np.repeat(fresh - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(int(sizes.sum()))
        start = np.repeat(fresh, sizes)
        lead = rows[(previous[rows] < start) & (target[rows] >= 0)]
        found = target[lead]
        found = found[lcp[found] == limit]  # all different, as each row leads to another one
        if length + 1 < limit:
            lcp[found] = length + 1
        fresh = found
    return order, lcp


def repeated_starts(segments: list[bytes], limit: int = WINDOW) -> list[np.ndarray]:
    """For every segment, the sorted starts of its ``limit``-byte strings that occur twice or more
    in all segments together."""
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"".join(segments), np.uint8)
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    begins, ends = np.repeat(firsts, sizes), np.repeat(firsts + sizes, sizes)
    order, lcp = bounded_prefixes(text, begins, ends, limit)
    long = lcp >= limit
    twice = long | np.concatenate((long[1:], [False]))
    at = np.sort(order[twice])
    cuts = np.searchsorted(at, np.concatenate((firsts, [len(text)])))
    return [at[cuts[i]:cuts[i + 1]] - firsts[i] for i in range(len(segments))]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _symbols(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)


def _pieces(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of overlapping parts that hold every window once."""
    for at in range(0, len(data) - WINDOW + 1, PIECE):
        yield at, data[at:at + PIECE + WINDOW - 1]


def document_anchors(texts: list[str]) -> np.ndarray:
    """The anchor keys of every text, once per anchoring place (twice where two pieces share it)."""
    found = [np.zeros(0, np.uint64)]
    for text in texts:
        for _, data in _pieces(_bytes(text)):
            grams = Prefix(_symbols(data), 0).runs(GRAM)
            found.append(grams[np.unique(anchors(grams, WINDOW - GRAM + 1))])
    return np.concatenate(found)


ROW = "k long, s1 long, s2 long, n int, key binary, starts array<int>, ends array<int>, seg binary"
_RANGE = pa.list_(pa.int32())


def suspicious_segments(docs: DataFrame, twice: np.ndarray, often: np.ndarray) -> DataFrame:
    """Segments whose windows may be repeated, one row per distinct segment and batch.

    A segment found once carries its place (key and start); one found again in its batch is
    repeated for sure: its places go out as ranges, in rows without a segment, and the row that
    competes carries a count of 2 and no place.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((twice, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, very = shipped.value
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            texts: list[bytes] = []
            for text in batch.column(1).to_pylist():
                texts.append(_bytes(text))
            for i, at, data in ((i, at, data) for i, t in enumerate(texts) for at, data in _pieces(t)):
                symbols = _symbols(data)
                one = Prefix(symbols, 0)
                grams = one.runs(GRAM)
                place = anchors(grams, WINDOW - GRAM + 1)
                first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
                last = np.concatenate((first[1:], [len(place)])) + WINDOW - 1
                keys = grams[place[first]]
                sure = maybe_repeated(keys, hot)
                first, last, keys = first[sure], last[sure], keys[sure]
                if not len(first):
                    continue
                large = maybe_repeated(keys, very)
                counts = last[large] - first[large] - WINDOW + 1
                each = np.repeat(first[large] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(
                    int(counts.sum()))  # the windows of very common anchors, one by one
                start = np.concatenate((first[~large], each))
                end = np.concatenate((last[~large], each + WINDOW))
                s1, s2 = one.spans(start, end), Prefix(mixed(symbols), 1).spans(start, end)
                parts.append((np.concatenate((keys[~large], s1[len(start) - len(each):])), s1, s2,
                              np.full(len(start), i), start + at, end + at))
            if not parts:
                continue
            k, s1, s2, row, start, end = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, row, s2, s1, k))
            k, s1, s2, row, start, end = (x[order] for x in (k, s1, s2, row, start, end))
            new = np.concatenate(([True], (np.diff(k) != 0) | (np.diff(s1) != 0) | (np.diff(s2) != 0)))
            own = np.flatnonzero(new)
            n = np.diff(np.concatenate((own, [len(k)])))
            keys, alone = batch.column(0), n == 1
            yield pa.RecordBatch.from_arrays([
                *(pa.array(x[own].view(np.int64)) for x in (k, s1, s2)), pa.array(np.minimum(n, 2).astype(np.int32)),
                keys.take(pa.array(np.where(alone, row[own], 0), mask=~alone)),
                pa.array([[s] if a else None for s, a in zip(start[own].tolist(), alone.tolist())], _RANGE),
                pa.array([[e] if a else None for e, a in zip(end[own].tolist(), alone.tolist())], _RANGE),
                pa.array([texts[r][s:e] for r, s, e in zip(row[own].tolist(), start[own].tolist(), end[own].tolist())],
                         pa.binary())], _names())
            sure = np.repeat(~alone, n)
            if sure.any():
                row, start, end = row[sure], start[sure], end[sure]
                order = np.lexsort((start, row))
                row, start, end = row[order], start[order], end[order]
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1, [len(row)])).tolist()
                ranges = [_united(start[i:j], end[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
                m = len(ranges)
                spread = mixed(row[cuts[:-1]].astype(np.uint64)).view(np.int64)  # any task will do
                yield pa.RecordBatch.from_arrays([
                    pa.array(spread), pa.array(spread), pa.array(spread), pa.nulls(m, pa.int32()),
                    keys.take(pa.array(row[cuts[:-1]])), pa.array([r[0].tolist() for r in ranges], _RANGE),
                    pa.array([r[1].tolist() for r in ranges], _RANGE), pa.nulls(m, pa.binary())], _names())

    return docs.select("key", "text").mapInArrow(run, ROW)


def _names() -> list[str]:
    return [part.split()[0] for part in ROW.split(", ")]


def _united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of ranges sorted by start; touching ones are one."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate(([0], np.flatnonzero(starts[1:] > reach[:-1]) + 1))
    return starts[new], reach[np.concatenate((new[1:] - 1, [len(starts) - 1]))]


def covered_ranges(segments: DataFrame) -> DataFrame:
    """(key, starts, ends): byte ranges that repeated windows cover, several rows per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(keys: list, starts: list, ends: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(starts, _RANGE), pa.array(ends, _RANGE)],
                ["key", "starts", "ends"])

        def solve(pack: list[dict]) -> pa.RecordBatch:
            """``pack``: distinct segments with their places."""
            many = [g for g in pack if g["shared"]]
            found = repeated_starts([g["seg"] for g in many]) if many else []
            keys, starts, ends = [], [], []
            for g, at in zip(many, found):
                g["ranges"] = merged_spans(at, WINDOW)
            for g in pack:
                if g["n"] >= 2:  # all of its windows are repeated
                    ranges = (np.array([0]), np.array([len(g["seg"])]))
                else:
                    ranges = g.get("ranges", ((), ()))
                if len(ranges[0]):
                    for key, start in g["places"]:
                        keys.append(key)
                        starts.append((ranges[0] + start).tolist())
                        ends.append((ranges[1] + start).tolist())
            return emit(keys, starts, ends)

        group, anchor, pack, held = {}, None, [], 0
        for batch in batches:
            done = batch.column(3).is_null()
            settled = batch.filter(done)
            if settled.num_rows:
                yield pa.RecordBatch.from_arrays([settled.column(4), settled.column(5), settled.column(6)],
                                                 ["key", "starts", "ends"])
            rest = batch.filter(pc.invert(done))
            cols = [rest.column(i).to_pylist() for i in range(8)]
            for k, s1, s2, n, key, starts, _, seg in zip(*cols):
                if k != anchor:
                    for g in group.values():
                        g["shared"] = len(group) > 1
                        held += len(g["seg"]) if g["shared"] else 0
                    pack.extend(g for g in group.values() if g["shared"] or g["n"] >= 2)
                    group, anchor = {}, k
                    if held >= PACK or len(pack) >= 50000:
                        yield solve(pack)
                        pack, held = [], 0
                g = group.setdefault((s1, s2), {"n": 0, "places": [], "seg": seg})
                g["n"] += n
                if key is not None:
                    g["places"].append((key, starts[0]))
        for g in group.values():
            g["shared"] = len(group) > 1
        pack.extend(g for g in group.values() if g["shared"] or g["n"] >= 2)
        if pack:
            yield solve(pack)

    return segments.repartition("k").sortWithinPartitions("k").mapInArrow(
        run, "key binary, starts array<int>, ends array<int>")


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, kept, starts, ends) per row; kept: the bytes that are left;
    starts and ends: the maximal removed byte ranges."""
    keyed = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    twice, often = repeated_cells(keyed, document_anchors, [2, HOT])
    ranges = covered_ranges(suspicious_segments(keyed, twice, often))
    # bounded by the bytes of one document: equal rows have the same ranges, which the set keeps once
    ranges = ranges.groupBy("key").agg(F.collect_set(F.struct("starts", "ends")).alias("ranges")).select(
        "key", F.flatten("ranges.starts").alias("starts"), F.flatten("ranges.ends").alias("ends"))
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                data = _bytes(text)
                if starts:
                    order = np.argsort(starts, kind="stable")
                    a, b = _united(np.array(starts)[order], np.array(ends)[order])
                else:
                    a = b = np.zeros(0, np.int64)
                kept = b"".join(data[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(data)]))
                out.append((len(data), len(data) - len(kept), kept, a.tolist(), b.tolist()))
            sizes, removed, kept, a, b = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()),
                 pa.array(a, _RANGE), pa.array(b, _RANGE)],
                ["doc_id", "n_bytes", "n_removed", "kept", "starts", "ends"])

    return keyed.join(ranges, "key", "left").select("doc_id", "text", "starts", "ends").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, kept binary, starts array<int>, ends array<int>")
