import pytest
from pyspark.sql import functions as F

from conftest import SF01, plan_text, rows
from kestrel.operators import mentions
from kestrel.plans import catalog
from kestrel.plans.tables import TERMS

LANGS = ["JavaScript", "Java", "PHP", "Python", "C#", "C++"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([
        (1, "Alpha", "Java and C++ Java"),
        (2, "Beta", "JavaScript, Java"),
        (3, "Gamma", "java C++\tPHP"),
    ], "doc_id long, title string, text string")


def test_mention_count_is_documents_not_occurrences(docs):
    assert rows(mentions.mention_count(docs, "Java")) == [(2,)]
    assert rows(mentions.mention_count(docs, "java")) == [(1,)]
    assert rows(mentions.mention_count(docs, "PHP")) == [(0,)]  # glued to C++ by a tab
    assert rows(mentions.mention_count(docs, "JavaScript")) == [(0,)]  # "JavaScript," keeps its comma


def test_postings_one_row_per_term_and_document(docs):
    got = sorted(rows(mentions.mention_postings(docs, LANGS)))
    assert got == [("C++", 1), ("Java", 1), ("Java", 2)]


def test_index(docs):
    idx = mentions.mention_index(mentions.mention_postings(docs, LANGS))
    got = {r.term: list(r.doc_ids) for r in idx.collect()}
    assert got == {"Java": [1, 2], "C++": [1]}


def test_index_articles(docs):
    got = sorted((r.term, r.title) for r in mentions.index_articles(docs, LANGS).collect())
    assert got == [("C++", "Alpha"), ("Java", "Alpha"), ("Java", "Beta")]


def test_index_articles_of_repeated_ids(spark):
    df = spark.createDataFrame([(1, "the a"), (1, "and")], "doc_id long, text string")
    out = mentions.index_articles(df, ["the", "and"])
    assert sorted(map(tuple, out.collect())) == [("and", 1, "and"), ("the", 1, "the a")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_index_blocks_are_bounded(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"))
    idx = mentions.mention_index(mentions.mention_postings(df, ["x"]), block=100)
    sizes = [len(r.doc_ids) for r in idx.collect()]
    assert len(sizes) == 10 and max(sizes) == 100 and sum(sizes) == 1000


def test_rankings_agree(docs):
    rank = rows(mentions.mention_rank(docs, LANGS))
    assert rank == [("Java", 2), ("C++", 1)]
    idx = mentions.mention_index(mentions.mention_postings(docs, LANGS))
    assert rows(mentions.rank_from_index(idx, LANGS)) == rank
    full = rows(mentions.mention_rank_full(docs, LANGS))
    assert full[:2] == rank
    # zero counts kept, ties in list order (or reversed)
    assert full[2:] == [("JavaScript", 0), ("PHP", 0), ("Python", 0), ("C#", 0)]
    rev = rows(mentions.mention_rank_full(docs, LANGS, reverse_ties=True))
    assert rev[2:] == [("C#", 0), ("Python", 0), ("PHP", 0), ("JavaScript", 0)]


def test_terms_validated(docs):
    with pytest.raises(ValueError):
        mentions.mention_rank(docs, ["Java", "Java"])
    with pytest.raises(ValueError):
        mentions.mention_rank(docs, [""])


def test_driver_rankings_agree(spark):
    a = rows(catalog.mention_rank(spark, SF01))
    b = rows(catalog.mention_rank_index(spark, SF01))
    c = rows(catalog.mention_rank_full(spark, SF01))
    assert a == b
    assert [r for r in c if r[1] > 0] == a
    assert {t for t, n in c if n == 0} >= {"C++", "Scala"}
    assert len(c) == len(TERMS)


def test_rank_plan_is_one_scan_with_partial_count(spark):
    df = catalog.mention_rank(spark, SF01)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1
    physical = plan_text(df)
    assert "PythonUDF" not in physical and "BatchEvalPython" not in physical
    assert "partial_count" in physical
    assert "ReadSchema: struct<text:string>" in physical  # the id is pruned for a count


@pytest.fixture(scope="module")
def text_docs(spark):
    rows = [(f"doc/{i % 400}", "Java PHP" if i % 3 else "Java") for i in range(500)] + [(None, "PHP"), ("é", "Java")]
    return spark.createDataFrame(rows, "doc_id string, text string")


def test_index_of_text_ids(text_docs):
    """Hashed blocks: the union of a term's blocks is its posting list, and no block outgrows its share."""
    postings = mentions.mention_postings(text_docs, LANGS)
    directory = {r.term: (r.n, r.blocks) for r in mentions.mention_directory(postings, 32).collect()}
    assert directory["Java"][0] == 501 and directory["Java"][1] == 32
    index = mentions.mention_index(postings, block=32).collect()
    for term in ("Java", "PHP"):
        blocks = [r for r in index if r.term == term]
        want = sorted((r.doc_id for r in postings.collect() if r.term == term and r.doc_id is not None))
        assert sorted(i for r in blocks for i in r.doc_ids) == want
        assert all(0 <= r.block < directory[term][1] and list(r.doc_ids) == sorted(r.doc_ids) for r in blocks)
        assert len({r.block for r in blocks}) == len(blocks) and max(len(r.doc_ids) for r in blocks) <= 64
    # an id is looked up in the one block that its hash names
    home = {i: r.block for r in index if r.term == "Java" for i in r.doc_ids}
    spark = text_docs.sparkSession
    found = spark.createDataFrame([(i,) for i in home], "i string").select("i", F.pmod(mentions.id_hash("i"), F.lit(32)))
    assert home == dict(rows(found))


def test_ranking_from_text_index(text_docs):
    postings = mentions.mention_postings(text_docs.where("doc_id IS NOT NULL"), LANGS)
    ranked = mentions.rank_from_index(mentions.mention_index(postings, block=16), LANGS)
    assert rows(ranked) == rows(mentions.mention_rank(text_docs.where("doc_id IS NOT NULL"), LANGS))


def test_growing_directory_splits_blocks(text_docs):
    """With twice the blocks, every block is split in two."""
    postings = mentions.mention_postings(text_docs.where("doc_id IS NOT NULL"), ["Java"])
    small, large = (mentions.mention_index_hashed(postings, mentions.mention_directory(postings, b)) for b in (64, 32))
    homes = {i: r.block for r in small.collect() for i in r.doc_ids}
    assert {homes[i] for r in large.collect() for i in r.doc_ids} == set(homes.values())
    assert all(r.block % 16 == homes[i] for r in large.collect() for i in r.doc_ids)


def test_bitmaps_hold_the_ids(spark):
    ids = [-70000, -32769, -32768, -32767, -1, 0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, 10 ** 12, None]
    postings = spark.createDataFrame([("a", i) for i in ids + ids[:3]] + [("b", 5)], "term string, doc_id long")
    bitmaps = mentions.mention_bitmaps(postings)
    assert sorted(rows(mentions.bitmap_ids(bitmaps))) == sorted([("a", i) for i in ids if i is not None] + [("b", 5)])
    assert rows(mentions.rank_from_bitmaps(bitmaps, ["b", "a", "c"])) == [("a", len(ids) - 1), ("b", 1)]
    assert {len(r.bitmap) for r in bitmaps.collect()} == {4096}
    assert rows(mentions.mention_bitmaps(postings.limit(0))) == []


def test_ranking_from_bitmaps_equals_mention_rank(spark):
    assert rows(catalog.mention_rank_bitmap(spark, SF01)) == rows(catalog.mention_rank(spark, SF01))
