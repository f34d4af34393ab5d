"""Driver tables and the parameters the driver queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators.kmeans import KMeansParams

# Parameters chosen for the driver data.  The documents carry none of the reference's language
# names, so the mention queries use common words; "C++" and "Scala" match nothing and exercise
# the zero fill.  Order priorities play the language list of the clustering (5 strata x 3 = 15
# centres).  Spread, eta and the iteration cap are the reference's values (KMeansParams).
TERMS = ["the", "and", "of", "is", "to", "was", "der", "die", "und", "la", "le", "de", "en", "C++", "Scala"]
COUNT_TERM = "the"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PER_STRATUM = 3
K = PER_STRATUM * len(PRIORITIES)
PAIR_BLOCK = 4     # pairs of a block: the derived questions have 1 to 7 answers
TEXT_BLOCK = 64    # ids of a hashed index block, about
SEED = "42:"
PARAMS = KMeansParams(k=K)
SPREAD = PARAMS.spread
ETA = PARAMS.eta
MAX_ITERATIONS = PARAMS.max_iterations

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared read schemas (the columns the queries use): no schema-inference job per read.
SCHEMAS = {
    "documents": "doc_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "orders": "o_orderkey bigint, o_orderpriority string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
