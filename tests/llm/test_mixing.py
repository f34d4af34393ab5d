import re
from collections import defaultdict

import pytest

from kestrel.llm import mixing
from tests.llm.edge import edge_frame, empty_frame

SF001 = "/root/testdata/sf0.001"


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute_targets(sizes):
    """{source: target} by resharing until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        capped |= above


def check(rows, docs):
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id is not None) == sorted(
        (d.doc_id, size_of(d.text)) for d in docs if d.doc_id is not None)
    assert len(rows) == len(docs)
    sizes = defaultdict(int)
    for d in docs:
        sizes[d.source] += size_of(d.text)
    targets, taken = brute_targets(dict(sizes)), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6


@pytest.mark.parametrize("block,shard", [(512, 1024), (7, 5)])
def test_mix_gives_the_targets(spark, block, shard):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = mixing.mix(docs, block=block, slots_per_shard=shard, buckets=8, bins=16).documents().collect()
    check(rows, docs.collect())
    again = mixing.mix(docs.repartition(5), block=block, slots_per_shard=shard, buckets=8, bins=16).documents()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_mix_edges(spark):
    docs = edge_frame(spark)
    check(mixing.mix(docs, block=3, slots_per_shard=4, buckets=4, bins=4).documents().collect(), docs.collect())
    assert mixing.mix(empty_frame(spark)).documents().count() == 0
    blank = docs.where("doc_id in (3, 4, 5)")
    assert {(r.size, r.target, r.taken) for r in mixing.mix(blank).documents().collect()} == {(0, 0.0, 0)}


def test_slot_texts_hold_the_taken_words(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    mixed = mixing.mix(docs, block=50, slots_per_shard=16, buckets=8, bins=16)
    texts = mixed.texts(docs).collect()
    slots = {(s.shard, s.skey, s.i): s.take for s in mixed.slots.collect()}
    assert len(texts) == len(slots)
    for t in texts:
        assert size_of(t.text) == slots[(t.shard, "=" + t.source, t.i)]
    assert max(sum(1 for s in slots if s[0] == k) for k in {s[0] for s in slots}) <= 16


def test_permutation_is_a_bijection(spark):
    from pyspark.sql import functions as F
    for n in (1, 2, 3, 100):
        df = spark.range(n).select("id", mixing.block_of_slot(F.col("id"), F.lit(n), F.lit(5)).alias("b"))
        back = df.select("id", "b", mixing.slot_of_block(F.col("b"), F.lit(n), F.lit(5)).alias("s")).collect()
        assert sorted(r.b for r in back) == list(range(n))
        assert all(r.s == r.id for r in back)
