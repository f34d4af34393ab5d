"""Rows that every operator must handle: nulls, empties, ties, repeats, clashing columns."""

from pyspark.sql import Row

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size long, bucket int, fp int"
LONG = " ".join(f"w{i % 977} word{i}" for i in range(60000))


def edge_rows():
    plain = "the cat sat on the mat and the dog lay on the rug near the old red door of the house by the sea"
    rows = [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain, "en", "b"), (3, None, "en", "a"),
        (4, "", None, None), (None, plain, "en", "a"), (5, " \t\n\x0b\x0c\r", "de", "c"), (6, "one", None, "c"),
        (7, LONG, "en", "a"), (8, "é ß   x", "fr", None), (9, "A b\nA b\n\nA b", "xx", ""),
        (None, None, None, None), (10, plain + " today", "en", "b"),
    ]
    return [Row(doc_id=i, text=t, lang=la, source=s, n_chars=len(t) if t is not None else None,
                key="k", size=7, bucket=1, fp=2) for i, t, la, s in rows]


def edge_frame(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
