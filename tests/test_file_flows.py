"""File-based flows on inputs written by Spark from the sf0.01 tables (multi-file, whole tables).

Each flow must give the same result as the catalogue query computed from the tables directly.
"""

from pyspark.sql import functions as F

from conftest import SF01, rows
from kestrel.operators import mentions
from kestrel.plans import catalog, flows
from kestrel.plans.tables import PARAMS, PRIORITIES, SEED, TERMS, table
from kestrel.sources import derived


def test_mention_rankings_from_page_file(spark, tmp_path):
    # one record per line: line breaks inside a text become spaces on both sides
    docs = table(spark, SF01, "documents").select(
        "doc_id", F.regexp_replace("text", "[\\r\\n]", " ").alias("text"))
    lines = docs.select(F.concat(F.lit("<page><title> "), F.col("doc_id").cast("string"),
                                 F.lit("</title><text>"), F.col("text"), F.lit("  </text></page>")))
    lines.repartition(4).write.text(str(tmp_path / "pages"))
    out = flows.mention_rankings(spark, str(tmp_path / "pages"), TERMS)
    want = rows(mentions.mention_rank_full(docs, TERMS))
    assert rows(out["ranking"]) == want
    assert rows(out["ranking_combined"]) == [r for r in want if r[1] > 0]
    assert rows(out["ranking_from_index"]) == [r for r in want if r[1] > 0]
    assert out["documents"].count() == docs.count()


def test_cluster_postings_from_csv_file(spark, tmp_path):
    lines = derived.posting_lines(table(spark, SF01, "orders"), table(spark, SF01, "lineitem"))
    lines.repartition(3).write.text(str(tmp_path / "postings"))
    model = flows.cluster_postings(spark, str(tmp_path / "postings"), PRIORITIES, PARAMS)
    assert model.fit.iterations >= 1
    assert rows(model.summary) == rows(catalog.cluster_summary(spark, SF01))
    assert SEED == "42:"  # the flow's default seed is the catalogue's


def test_time_usage_from_wide_csv_files(spark, tmp_path):
    frame = derived.survey_frame(table(spark, SF01, "lineitem"))
    frame.repartition(3).write.option("header", True).option("quoteAll", True).csv(str(tmp_path / "atus"))
    out = flows.time_usage_by_life_period(spark, str(tmp_path / "atus"))
    assert rows(out["grouped"]) == rows(catalog.time_usage_grouped(spark, SF01))
    assert rows(out["grouped_typed"]) == rows(catalog.time_usage_grouped_typed(spark, SF01))
    assert out["summary"].count() == catalog.time_usage_summary(spark, SF01).count()
