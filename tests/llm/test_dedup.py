import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np

from kestrel.llm import substrings, suffixes
from tests.llm.edge import edge_frame, empty_frame

SF001 = "/root/testdata/sf0.001"


def ws(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def brute_words(docs, n=50):
    """[(doc_id, n_words, n_removed, kept)] of (doc_id, text) rows."""
    least = {}
    big = float("inf")
    for i, t in docs:
        w = ws(t)
        for j in range(len(w) - n + 1):
            key = tuple(w[j:j + n])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for i, t in docs:
        w, gone = ws(t), set()
        for j in range(len(w) - n + 1):
            if least[tuple(w[j:j + n])] < (big if i is None else i):
                gone.update(range(j, j + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def brute_bytes(docs, n=200):
    datas = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(hashlib.md5(d[j:j + n]).digest() for _, d in datas for j in range(len(d) - n + 1))
    out = []
    for i, d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for j in range(len(d) - n + 1):
            if count[hashlib.md5(d[j:j + n]).digest()] > 1:
                gone[j:j + n] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


def got_words(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(docs).collect()),
                  key=str)


def got_bytes(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.starts), bytes(r.kept))
                   for r in suffixes.dedup_bytes(docs).collect()), key=str)


def planted(seed=3):
    """Documents with shared passages, periodic texts, copies and edits."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "日本"]
    passages = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (49, 50, 51, 80, 200)]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 90)))]
        for p in rnd.sample(passages, rnd.randint(0, 2)):
            parts += [p, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60)))]
        docs.append((rnd.randint(0, 40), rnd.choice([" ", "\n", "  "]).join(parts)))
    docs += [(50, "a b c d e " * 100), (51, "x" * 900), (52, "x" * 199), (53, "x" * 200), (50, "a b c d e " * 100),
             (None, docs[0][1]), (None, docs[1][1]), (61, docs[5][1] + " tail"), (60, "ab" * 300 + "c" + "ab" * 200)]
    return docs


def test_word_hashes_of_pieces(monkeypatch):
    text = " ".join(["a", "bb", "é" * 40, "日本", "x" * 300] * 30) + " "
    whole = [h.tolist() for h in substrings.word_hashes(text)]
    monkeypatch.setattr(substrings, "PIECE", 64)
    assert [h.tolist() for h in substrings.word_hashes(text)] == whole
    assert all(len(h) == 150 and len(set(h)) == 5 for h in whole)


def test_words_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_words(rows)
    assert any(w[2] for w in want)
    assert got_words(docs) == want
    rows = planted()
    assert got_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute_words(rows)


def test_bytes_against_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_bytes(rows)
    assert any(w[2] for w in want)
    assert got_bytes(docs) == want
    rows = planted()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got_bytes(frame) == brute_bytes(rows)
    monkeypatch.setattr(suffixes, "HOT", 3)     # many anchors take the way of very common ones
    monkeypatch.setattr(suffixes, "PACK", 500)  # and many packs are sorted
    monkeypatch.setattr(suffixes, "PIECE", 150)  # and texts go piece by piece
    assert got_bytes(frame) == brute_bytes(rows)


def test_edges(spark):
    docs = edge_frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got_words(docs) == brute_words(rows)
    assert [r[:3] for r in got_bytes(docs)] == [r[:3] for r in brute_bytes(rows)]
    assert got_words(empty_frame(spark)) == [] and got_bytes(empty_frame(spark)) == []


def test_bounded_prefixes():
    rnd = random.Random(2)
    for _ in range(400):
        segs = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 25))) for _ in range(rnd.randint(1, 5))]
        segs += [segs[0], segs[0][:rnd.randint(1, len(segs[0]))]]
        limit = rnd.randint(1, 10)
        count = Counter(s[i:i + limit] for s in segs for i in range(len(s) - limit + 1))
        for s, found in zip(segs, suffixes.repeated_starts(segs, limit)):
            assert found.tolist() == [i for i in range(len(s) - limit + 1) if count[s[i:i + limit]] > 1]


def test_anchors_of_equal_windows_agree():
    from kestrel.llm.repeats import Prefix, anchors
    rnd = random.Random(4)
    data = np.array([rnd.randrange(3) for _ in range(500)], np.uint64)
    grams = Prefix(data, 0).runs(4)
    seen = defaultdict(set)
    for i, p in enumerate(anchors(grams, 9).tolist()):
        assert i <= p < i + 9
        seen[tuple(data[i:i + 12].tolist())].add(p - i)
    assert all(len(v) == 1 for v in seen.values())


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate({97: 98, 98: 97})
    return word


def test_words_that_collide_in_every_polynomial_hash(spark):
    """A Thue-Morse word and its complement: equal modulo 2^64 under any odd base, yet two words."""
    one = thue_morse(1024)
    other = one.translate({97: 98, 98: 97})
    same = " ".join(f"w{i}" for i in range(49))
    docs = [(1, f"{one} {same}"), (2, f"{other} {same}"), (3, f"{same} {one}"), (4, f"{same} {one} end")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got_words(frame) == brute_words(docs)
    assert {i: n for i, _, n, _ in got_words(frame)} == {1: 0, 2: 0, 3: 0, 4: 50}


def test_word_hashes_do_not_depend_on_other_words():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 3, 8, 9, 16, 63, 64, 65, 200]))) for _ in range(400)]
    alone = [tuple(int(h[0]) for h in substrings.word_hashes(w)) for w in words]
    first, second = substrings.word_hashes("\n ".join(words) + " ")
    assert list(zip(first.tolist(), second.tolist())) == alone
    assert len(set(first.tolist())) == len(set(second.tolist())) == len(set(words))
    assert not set(first.tolist()) & set(second.tolist())


def test_many_equal_rows(spark):
    """Equal rows share one set of ranges, however many there are."""
    text = " ".join(f"word{i}" for i in range(120))
    rows = [(5, text)] * 3000 + [(1, text + " more"), (7, "x " + text)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    found = Counter((r.doc_id, r.n_removed) for r in substrings.dedup_substrings(frame).collect())
    assert found == {(1, 0): 1, (5, 120): 3000, (7, 120): 1}
    found = Counter((r.doc_id, r.n_bytes - r.n_removed) for r in suffixes.dedup_bytes(frame).collect())
    assert found == {(1, 5): 1, (5, 0): 3000, (7, 2): 1}
