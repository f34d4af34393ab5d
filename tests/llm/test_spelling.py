"""Spelling variants against brute force: all near words of a word, forms and roots."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from conftest import SF001
from kestrel.llm import spelling
from kestrel.llm.queries import QUERIES
from tests.llm.edge import edge_frame, empty_frame

COLUMNS = ["word", "n", "form", "root", "n_near", "form_n"]


def variants_of(counts, ratio=2):
    """{word: (n, form, root, n_near, form_n)} by deleting every code point of every word."""
    across, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            across[i, w[:i] + w[i + 1:]].add(w)
    for (_, rest), ws in across.items():
        for w in ws:
            near[w] |= ws - {w}
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, form[w], root, len(near[w]), counts.get(form[w]))
    return out


def words_of(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def collected(df):
    assert df.columns == COLUMNS
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture()
def many_partitions(spark):
    """Words dealt over more partitions than AQE would leave, so that trie nodes span them."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert collected(QUERIES["op12_spelling_variants"](spark, SF001)) == variants_of(words_of(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words_over_many_partitions(spark, many_partitions, seed):
    """Two letters, all lengths: long runs of equal letters, many near words, chains of forms."""
    rng = random.Random(seed)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))): rng.choice([1, 2, 3, 5, 9, 20, 50, 99])
              for _ in range(300)}
    got = collected(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == variants_of(counts)


def test_words_of_every_kind_of_neighbour(spark):
    counts = {"abcde": 40, "abcdef": 9, "bcde": 3, "xabcde": 3, "abxcde": 3, "abde": 3, "abcdé": 2, "aabcde": 1,
              "zzzzz": 5, "zzzz": 9, "zzzzzz": 100, "vwxyz": 7}
    got = collected(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == variants_of(counts)
    assert got["zzzz"][:2] == (9, None) and got["zzzzz"] == (5, "zzzzzz", "zzzzzz", 2, 100)
    assert got["vwxyz"] == (7, None, "vwxyz", 0, None)


def test_very_long_words_cost_their_length(spark):
    long = "ab" * 20000
    counts = {long: 9, long + "c": 3, long[:30000] + "x" + long[30000:]: 4, long[:-1] + "z": 1, "short": 2}
    got = collected(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got[long][3] == 3 and got[long + "c"][1] == long and got["short"][3] == 0
    assert got[long[:-1] + "z"][:2] == (1, long)  # replaced; one more code point away from the others


def test_damage_names_the_code_point(spark):
    rows = [(i, "Straße " * 3 + "ÀÉÎõü×÷ fooBAR") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(r[0] for r in spelling.damaged(spelling.runs(df)).collect())
    assert {w: n for w, n in found.items() if len(w) >= 5 and n >= 3} == words_of(rows)
    assert "straße" in found and "ÀÉÎõü×÷" in found and len(found) > 3


def test_edges(spark):
    df = edge_frame(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    clashing = df.withColumnsRenamed({"key": "word", "size": "n", "bucket": "id", "fp": "place"})
    for frame in (df, clashing):
        got = spelling.variants(spelling.count_words(spelling.damaged(spelling.runs(frame))))
        assert collected(got) == variants_of(words_of(rows))
    empty = spelling.variants(spelling.count_words(spelling.damaged(spelling.runs(empty_frame(spark)))))
    assert collected(empty) == {}
