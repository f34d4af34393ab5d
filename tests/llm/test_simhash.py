import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from kestrel.llm import graph, simhash
from tests.llm.edge import edge_frame, empty_frame

SF001 = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall("[^\x20\x09-\x0d]+", low)
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance=3):
    """Smallest id reachable, by index of (id, fingerprint)."""
    n, root = len(values), list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (values[i][1] ^ values[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(n):
        if values[i][0] is not None:
            least[find(i)].append(values[i][0])
    return [min(least[find(i)], default=None) for i in range(n)]


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    values = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = sorted((i, f, c) for (i, f), c in zip(values, brute_components(values)))
    got = sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want


def test_links_of_dense_groups(spark):
    """Clusters, chains and blocks smaller than a cluster: components equal those of all pairs."""
    rnd = random.Random(5)
    values = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(40):
            for _ in range(rnd.randint(0, 3)):
                x ^= 1 << rnd.randrange(64)
            values.add(x)
    values = sorted(values | {0, 2**64 - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    want = brute_components([(i, v) for i, v in enumerate(values)])
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    for segments, block, extra in ((16, 8, 0), (16, 1024, 2), (16, 8, 3), (16, 5, 5), (4, 1024, 0), (8, 3, 3)):
        links = simhash.fingerprint_links(fps, segments=segments, block=block, extra=extra)
        roots = {r.node: r.root for r in graph.connected_components(links).collect()}
        groups = defaultdict(set)
        for i, v in enumerate(signed):
            groups[roots.get(v, ("alone", v))].add(i)
        brute = defaultdict(set)
        for i, c in enumerate(want):
            brute[c].add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_edges(spark):
    got = simhash.near_duplicates(edge_frame(spark)).collect()
    assert len(got) == edge_frame(spark).count()
    blank = {(r.doc_id, r.component_id) for r in got if r.fp == 0}
    assert blank == {(3, 3), (4, 3), (5, 3), (None, 3)}
    same = [r for r in got if r.fp == next(x.fp for x in got if x.doc_id == 2)]
    assert {r.component_id for r in same} == {1} and len(same) >= 4
    assert simhash.near_duplicates(empty_frame(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = edge_frame(spark)
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert [r.doc_id for r in kept if r.text is None or not r.text.strip()] == [3]
    assert len([r for r in kept if r.doc_id == 1]) == 1 and not [r for r in kept if r.doc_id == 2]
    assert simhash.drop_near_duplicates(empty_frame(spark)).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in graph.connected_components(links).collect()}
    assert {roots[i] for i in range(61)} == {roots[0]} and roots[100] == roots[101] != roots[0]


def test_extra_segments_shorten_groups(spark):
    """Longer keys: the same components from far fewer pairs."""
    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(1500)]
    values = sorted({x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for x in base} | set(base))
    # a third share their first 24 bits, so keys of 20 bits hold them all
    values = sorted({x & (2**40 - 1) if i % 3 == 0 else x for i, x in enumerate(values)})
    fps = spark.createDataFrame([(v,) for v in np.array(values, np.uint64).view(np.int64).tolist()], "fp long")
    found = [set(map(tuple, simhash.fingerprint_links(fps, extra=extra).collect())) for extra in (0, 5)]
    linked = {frozenset((i, j)) for i, a in enumerate(values) for j, b in enumerate(values[:i]) if (a ^ b).bit_count() <= 3}
    place = {v: i for i, v in enumerate(np.array(values, np.uint64).view(np.int64).tolist())}
    for links in found:
        assert {frozenset((place[a], place[b])) for a, b in links} <= linked
    assert components(found[0], place) == components(found[1], place) == components(
        [(a, b) for a, b in map(tuple, linked)], {i: i for i in range(len(values))})


def components(links, place):
    root = list(range(len(place)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(place[a]), find(place[b])))
        root[y] = x
    return [find(i) for i in range(len(place))]
