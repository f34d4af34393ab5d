"""Packing: ids, gapless pieces and sequences, whole windows, BM25 order against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF001, SF01
from kestrel.llm import packing
from kestrel.llm.queries import QUERIES
from tests.llm.edge import edge_frame, edge_rows, empty_frame

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(exact, text):
    return [*exact.encode(text or "", add_special_tokens=False).ids, 1]


def check_pieces(pieces, documents, size=packing.SIZE):
    """Every id in exactly one piece, sequences gapless; returns the lengths of the sequences."""
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc_id, texts in documents.items():
        left = Counter()
        for p in by_doc.pop(doc_id):
            assert 0 < p.length <= size
            left[p.start, p.length, p.ids_crc32, p.doc_tokens] += 1
        for ids in texts:  # rows of equal ids: take away one chain of pieces each
            at = 0
            while at < len(ids):
                fit = next(k for k in left if left[k] and k[0] == at and k[3] == len(ids)
                           and k[2] == zlib.crc32(np.array(ids[at:at + k[1]], "<u4").tobytes()))
                left[fit] -= 1
                at += fit[1]
        assert not +left
    assert not by_doc
    lengths = []
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_query_packs_every_id_once(spark, exact, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    df = QUERIES["op11_lexical_packing"](spark, folder)
    assert df.columns == COLUMNS
    documents = {r.doc_id: [ids_of(exact, r.text)] for r in rows}
    lengths = check_pieces(df.collect(), documents)
    assert all(n & (n - 1) == 0 for n in lengths)  # nothing is padded
    assert lengths.count(packing.SIZE) >= 0.98 * sum(lengths) / packing.SIZE


def test_ids_are_those_of_tokenizers(exact):
    rng = random.Random(3)
    parts = ["a", "the", "don't", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", "é", "ß", "12", "²", "'s",
             "!", "#", "<|endoftext|>", "<|endof", "中", "\U0001f600", "́", "\x00", "ǅ"]
    encode = packing.encoder(packing.VOCABULARY)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert encode(text).tolist() == ids_of(exact, text)[:-1], repr(text)
    for text in (" " * 400000, "\n" * 300000, "a" * 100000, " x " + "\t" * 200000 + "y"):
        assert encode(text).tolist() == ids_of(exact, text)[:-1]


def test_long_texts_are_encoded_in_parts(exact, monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    encode = packing.encoder(packing.VOCABULARY)
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["word", " ", "  ", "x1", "é ", "\n", ". ", "<|endoftext|>", "'ll"]) for _ in range(200))
        assert encode(text).tolist() == ids_of(exact, text)[:-1]


def test_index_ranks_by_bm25():
    rng = random.Random(6)
    rests = [np.array([rng.randint(0, 40) for _ in range(rng.randint(1, 60))], "<u2") for _ in range(30)]
    frequency = np.zeros(50)
    for r in rests:
        frequency[np.unique(r)] += 1
    total = sum(map(len, rests))
    stats = packing.Statistics(frequency, len(rests), total)
    index = packing.Shard(rests, stats)
    for seed in range(30):
        scores = []
        for r in rests:
            score = 0.0
            for t in set(rests[seed].tolist()):
                tf, df = (r == t).sum(), frequency[t]
                idf = np.log(1 + (30 - df + 0.5) / (df + 0.5))
                score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(r) / (total / 30)))
            scores.append(score)
        got = index.ranked(index.terms[seed])
        assert sorted(got.tolist()) == list(range(30))
        assert all(scores[a] >= scores[b] - 1e-9 for a, b in zip(got, got[1:]))


def test_neighbours_share_windows(spark, exact):
    """Texts of two vocabularies, interleaved: a window holds one of them but at the borders."""
    rng = random.Random(8)
    topics = ["apple pear plum cherry grape melon fig date".split(), "iron zinc lead copper tin silver gold nickel".split()]
    rows = [(i, " ".join(rng.choice(topics[i % 2]) for _ in range(rng.randint(60, 200)))) for i in range(300)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    check_pieces(pieces, {i: [ids_of(exact, t)] for i, t in rows})
    topics_of = defaultdict(set)
    for p in pieces:
        topics_of[p.sequence_id].add(p.doc_id % 2)
    assert sum(len(t) > 1 for t in topics_of.values()) <= 3 + len(topics_of) // 10


@pytest.mark.parametrize("size,shard", [(8, 3), (7, 1), (64, 5)])
def test_small_sequences_and_shards(spark, exact, size, shard):
    df = spark.read.parquet(f"{SF001}/documents.parquet").limit(60)
    rows = df.select("doc_id", "text").collect()
    pieces = packing.pack(df, size=size, shard=shard).collect()
    lengths = check_pieces(pieces, {r.doc_id: [ids_of(exact, r.text)] for r in rows}, size)
    assert all(n == size or n & (n - 1) == 0 for n in lengths)


def test_edges(spark, exact):
    documents = defaultdict(list)
    for r in edge_rows():
        documents[r.doc_id].append(ids_of(exact, r.text))
    clashing = edge_frame(spark).withColumnsRenamed({"key": "rest", "size": "windows", "bucket": "row", "fp": "first"})
    for frame in (edge_frame(spark), clashing, edge_frame(spark).repartition(7)):
        check_pieces(packing.pack(frame).collect(), documents)
    assert packing.pack(empty_frame(spark)).collect() == []
    nothing = spark.createDataFrame([(str(i), None) for i in range(5000)], "doc_id string, text string")
    pieces = packing.pack(nothing).collect()
    assert len(check_pieces(pieces, {str(i): [[1]] for i in range(5000)})) < 40
