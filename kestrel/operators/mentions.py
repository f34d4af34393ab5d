"""Which terms occur in which documents: counts, postings, inverted index, rankings.

A document mentions a term when the term is one of its space-separated tokens (see
``kestrel.functions.tokens``).  All rankings count documents, not occurrences.

Scale notes: every operator is one scan of the documents.  Term matching is a per-row hash
intersection of the token array with the literal term list; counts use partial aggregation, so
the shuffle carries at most (terms x map tasks) rows whatever the data size, and a term that
occurs in a third of all documents is no hotter than any other.  The inverted index is kept in
bounded blocks of document ids instead of one unbounded array per term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import (col, literal_table, mentions, position_in, quote_identifier, sort_bounded,
                               string_array, tokens)

DEFAULT_BLOCK = 1 << 16


def validate_terms(terms: Sequence[str]) -> list[str]:
    """Terms must be non-empty and unique (list order is the tie-break order).

    A term holding a space can never equal a token, so it is allowed and simply counts 0.
    """
    out = list(terms)
    if not out:
        raise ValueError("no terms given")
    for t in out:
        if not isinstance(t, str) or t == "":
            raise ValueError(f"invalid term {t!r}: terms are non-empty strings")
    if len(set(out)) != len(out):
        raise ValueError("duplicate terms: each would be counted twice")
    return out


def mention_count(docs: DataFrame, term: str, text_col: str = "text") -> DataFrame:
    """Number of documents whose text mentions ``term`` (A1, F1, F2): one row, column ``n``."""
    validate_terms([term])
    return docs.where(mentions(text_col, term)).agg(F.count(F.lit(1)).alias("n"))


def mention_postings(docs: DataFrame, terms: Sequence[str], id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row (term, doc id) per distinct term mentioned in each document."""
    terms = validate_terms(terms)
    matched = F.array_intersect(tokens(text_col), string_array(terms))
    return docs.select(F.explode(matched).alias("term"), col(id_col).alias(id_col))


def mention_index(postings: DataFrame, id_col: str = "doc_id", block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inverted index (A2): (term, block, sorted array of doc ids).

    Documents are cut into id ranges of ``block`` ids (``block`` column = first id of the
    range), so one row holds at most ``block`` ids however common the term is; the union of a
    term's blocks is its full posting list.  Grouping by (term, block) also spreads a hot term
    over many reducers.  Ids that aren't integers have no ranges: their blocks are those of
    ``mention_index_hashed`` under a directory of ``block``.
    """
    if block <= 0:
        raise ValueError("block must be positive")
    if not isinstance(postings.schema[id_col].dataType, T.IntegralType):
        return mention_index_hashed(postings, mention_directory(postings, block), id_col)
    ids = col(id_col)
    start = (ids - F.pmod(ids, F.lit(block).cast("bigint"))).cast("bigint")
    return (postings
            .groupBy("term", start.alias("block"))
            .agg(F.sort_array(F.collect_list(id_col)).alias(f"{id_col}s")))


def mention_directory(postings: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Block directory of an index over ids of any type (A2): (term, n, blocks).

    ``blocks`` is a power of two such that the ``n`` postings of the term, dealt by a hash of their id, come
    to half a block each on average.  At most one row per term.
    """
    if block <= 0:
        raise ValueError("block must be positive")
    above = F.expr(f"(2 * n - 1) div {int(block)}")  # one less than half blocks needed
    bits = F.when(above == 0, 0).otherwise(F.length(F.bin(above)))
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "blocks", F.pow(F.lit(2.0), bits).cast("bigint"))


def id_hash(c: str | Column) -> Column:
    """60 bits of the md5 of an id's text, as BIGINT; NULL as the empty text."""
    digest = F.md5(F.coalesce(col(c).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def mention_index_hashed(postings: DataFrame, directory: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Inverted index for ids of any type (A2): (term, block, sorted array of ids).

    ``block`` is the hash of the id modulo the term's ``blocks`` in the directory, so an id is looked up in one
    block, and doubling a term's blocks splits each of them in two.  The directory has one row per
    term (a caller's list), which is why it may be broadcast.
    """
    placed = postings.join(F.broadcast(directory.select("term", "blocks")), "term")
    return (placed.groupBy("term", F.pmod(id_hash(id_col), F.col("blocks")).alias("block"))
            .agg(F.sort_array(F.collect_list(id_col)).alias(f"{id_col}s")))


BITMAP_IDS = 32768  # ids of one bitmap, fixed by Spark's bitmap functions


def mention_bitmaps(postings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Inverted index in compressed blocks for integer ids (A2): (term, bucket, bitmap BINARY).

    A bitmap of 4 KB holds the ids of a range of ``BITMAP_IDS``; it is built by partial aggregation, so
    the shuffle carries bitmaps, not ids.  An id is in or out: repeated ids of a term count once, and
    NULL ids are left out.
    """
    ids = col(id_col).cast("bigint")
    return postings.where(ids.isNotNull()).groupBy("term", F.bitmap_bucket_number(ids).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("bitmap"))


def rank_from_bitmaps(bitmaps: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Ranking computed from the bitmaps (A3, A4, O2): bits set per term; absent terms absent."""
    terms = validate_terms(terms)
    ranked = bitmaps.groupBy("term").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    return _rank_order(ranked, terms)


def bitmap_ids(bitmaps: DataFrame) -> DataFrame:
    """The ids of the bitmaps, exploded: (term, id BIGINT).  Inverse of ``mention_bitmaps``."""
    # bit position p of bucket b is id (b - 1) * 32768 + 1 + p for positive ids, -(b * 32768 + p) otherwise
    byte = F.expr("posexplode(transform(sequence(1, length(bitmap)), i -> conv(hex(substring(bitmap, i, 1)), 16, 10)))")
    some = bitmaps.select("term", "bucket", byte.alias("at", "byte")).where(F.col("byte") != "0")
    bits = F.expr("filter(sequence(0, 7), k -> (CAST(byte AS INT) & shiftleft(1, k)) != 0)")
    each = some.select("term", "bucket", "at", F.explode(bits).alias("k"))
    place = F.col("at") * 8 + F.col("k")
    return each.select("term", F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BITMAP_IDS + 1 + place)
                       .otherwise(F.col("bucket") * BITMAP_IDS - place).alias("id"))


def index_articles(docs: DataFrame, terms: Sequence[str], text_col: str = "text") -> DataFrame:
    """The index with whole documents (A2 as the reference returns it), exploded: one row per
    (term, document) with every document column.

    One narrow projection of the documents: no id is needed, nothing is joined or shuffled, and
    documents that share an id stay apart.
    """
    terms = validate_terms(terms)
    matched = F.array_intersect(tokens(text_col), string_array(terms))
    return docs.select(F.explode(matched).alias("term"), *[col(quote_identifier(c)) for c in docs.columns])


def _rank_order(df: DataFrame, terms: Sequence[str], reverse_ties: bool = False) -> DataFrame:
    """Descending count; ties in term-list order (reversed with ``reverse_ties``).

    A ranking has at most len(terms) rows, so it is sorted as a bounded result.
    """
    pos = position_in(terms, "term")
    return sort_bounded(df, F.col("n").desc(), pos.desc() if reverse_ties else pos.asc())


def rank_from_index(index: DataFrame, terms: Sequence[str], ids_col: str = "doc_ids") -> DataFrame:
    """Ranking computed from the index (A3, A4, O2): size of each posting list; absent terms absent."""
    terms = validate_terms(terms)
    ranked = index.groupBy("term").agg(F.sum(F.size(ids_col)).cast("bigint").alias("n"))
    return _rank_order(ranked, terms)


def mention_rank(docs: DataFrame, terms: Sequence[str], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Ranking in one pass with partial counts (A5, O2); zero-count terms are absent."""
    terms = validate_terms(terms)
    counted = (mention_postings(docs, terms, id_col, text_col)
               .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return _rank_order(counted, terms)


def mention_rank_full(docs: DataFrame, terms: Sequence[str], id_col: str = "doc_id",
                      text_col: str = "text", reverse_ties: bool = False) -> DataFrame:
    """Ranking of every term, zero counts included.

    The term dimension is the caller's list (a literal inline table, size fixed by the
    parameter); it is joined to at most len(terms) count rows.  Ties come out in list order;
    ``reverse_ties=True`` gives the reverse list order that an ascending stable sort followed
    by a reversal produces.
    """
    terms = validate_terms(terms)
    spark = docs.sparkSession
    dim = literal_table(spark, [(t,) for t in terms], [("term", "string")])
    counted = (mention_postings(docs, terms, id_col, text_col)
               .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    full = dim.join(counted, "term", "left").select(
        "term", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"))
    return _rank_order(full, terms, reverse_ties)
