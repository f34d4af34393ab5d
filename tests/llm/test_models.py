"""Decontamination and language identification."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from kestrel.llm import decontam, langid
from tests.llm.edge import edge_frame, empty_frame

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_tiling(a, b, least):
    """Words covered by greedy string tiling, comparing every pair of positions."""
    used_a, used_b, total = [x < 0 for x in a], [x < 0 for x in b], 0
    while True:
        best, at = 0, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not (
                        used_a[i + k] or used_b[j + k]):
                    k += 1
                if k > best:
                    best, at = k, [(i, j)]
                elif k and k == best:
                    at.append((i, j))
        if best < least:
            return total
        for i, j in at:
            if not any(used_a[i:i + best]) and not any(used_b[j:j + best]):
                used_a[i:i + best] = used_b[j:j + best] = [True] * best
                total += best


def test_tiles_are_greedy():
    rnd = random.Random(3)
    for _ in range(600):
        a = [rnd.randrange(4) for _ in range(rnd.randint(3, 30))]
        b = [rnd.randrange(-1, 4) for _ in range(rnd.randint(0, 50))]
        tiles = decontam.greedy_tiles(a, b, 3)
        for k, i, j in tiles:
            assert a[i:i + k] == b[j:j + k] and min(b[j:j + k]) >= 0
        for side in (1, 2):
            covered = [x for t in tiles for x in range(t[side], t[side] + t[0])]
            assert len(covered) == len(set(covered))
        assert sum(t[0] for t in tiles) == brute_tiling(a, b, 3)


def test_reordered_and_copied_passages(spark):
    rnd = random.Random(5)
    benchmark = spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = []
    for i, text in items:
        ws = text.split()
        third = len(ws) // 3
        parts = [ws[:third], ws[third:2 * third], ws[2 * third:]]
        rnd.shuffle(parts)
        rows.append((i, "before it " + " and then ".join(" ".join(p) for p in parts) + " after it"))
        rows.append((1000 + i, f"x {text.title() if i % 2 else text} y"))
        rows.append((2000 + i, " ".join(ws[:len(ws) // 3])))
    rows += [(5000, None), (5001, ""), (5002, "the of and to")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (decontam.BLOCK_ITEMS, 7):  # also with the benchmark in several blocks
        got = {r.doc_id: r for r in decontam.contamination(docs, benchmark, block_items=block).collect()}
        assert len(got) == len(rows)
        for i, _ in items:
            assert got[i].contaminated and str(i) in got[i]["items"].split(",")
            assert got[1000 + i].contaminated and got[1000 + i].coverage == 1.0
            assert not got[2000 + i].contaminated
        assert not any(got[i].contaminated for i in (5000, 5001, 5002))


def test_decontamination_edges(spark):
    benchmark = spark.read.parquet(f"{SF001}/benchmark.parquet")
    docs = edge_frame(spark)
    assert decontam.contamination(docs, benchmark).where("contaminated").count() == 0
    assert decontam.drop_contaminated(docs, benchmark.limit(0)).count() == docs.count()
    odd = spark.createDataFrame([(1, None), (2, "short one"), (None, docs.first().text), (3, docs.first().text)],
                                "item_id long, text string")
    left = decontam.drop_contaminated(docs, odd)
    assert left.columns == docs.columns and 1 not in {r.doc_id for r in left.collect()}
    assert decontam.contamination(empty_frame(spark), benchmark).count() == 0


def test_code_lengths_are_exact():
    rnd = random.Random(2)
    texts = {"aa": ["".join(rnd.choice("abc é") for _ in range(300))], "bb": ["".join(rnd.choice("cdñ ") for _ in range(300))]}
    langs, la, ke, co, counts = sorted(texts), [], [], [], []
    for i, lang in enumerate(langs):
        seen = Counter()
        for t in texts[lang]:
            data = langid.normal_bytes(t)
            k, n = np.unique(langid.grams(np.frombuffer(data, np.uint8)), return_counts=True)
            la += [i] * len(k)
            ke.append(k)
            co.append(n)
            for at in range(langid.ORDER, len(data)):
                for order in range(langid.ORDER + 1):
                    seen[data[at - order:at + 1]] += 1
        counts.append(seen)
    model = langid.build_model(langs, np.array(la), np.concatenate(ke), np.concatenate(co).astype(float))

    def cost(seen, gram):
        if not gram:
            return 8.0
        after = [n for g, n in seen.items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
        if seen[gram]:
            return math.log2((sum(after) + len(after)) / seen[gram])
        return (math.log2((sum(after) + len(after)) / len(after)) if after else 0) + cost(seen, gram[1:])

    for text in ("abc", "xyz жук", "", "cab ñd é" * 3):
        data = langid.normal_bytes(text)
        want = [sum(cost(s, data[at - langid.ORDER:at + 1]) for at in range(langid.ORDER, len(data))) for s in counts]
        assert np.allclose(model.bits([data])[0], want, rtol=1e-4)
    joint = model.bits([langid.normal_bytes(t) for t in ("abc", "cab ñd")])
    assert np.allclose(joint[1], model.bits([langid.normal_bytes("cab ñd")])[0])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    docs = edge_frame(spark)
    got = langid.identify(docs).collect()
    assert len(got) == docs.count()
    for r, told in ((r, r.doc_id in (3, 4, 5)) for r in got if r.doc_id is not None):
        assert (r.lang_pred == "und" and r.score == 0) == told
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert langid.identify(empty_frame(spark)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_long_text_goes_in_pieces(spark, monkeypatch):
    model = langid.train(spark.read.parquet(f"{SF001}/documents.parquet"))
    text = langid.normal_bytes("the quick brown fox " * 400)
    whole = model.bits([text])
    monkeypatch.setattr(langid, "SLICE", 100)
    assert np.allclose(model.bits([text]), whole)
