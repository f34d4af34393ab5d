import pytest

from conftest import rows
from kestrel.operators.kmeans import KMeansParams
from kestrel.plans import flows
from test_qa import LINES
from test_sources import PAGES, SURVEY_CSV


def test_mention_rankings_flow(spark, tmp_path):
    path = tmp_path / "wiki.dat"
    path.write_text("\n".join(PAGES) + "\n")
    out = flows.mention_rankings(spark, str(path), ["JavaScript", "Java", "PHP", "Python", "C#", "C++"])
    assert rows(out["ranking_combined"]) == [("Java", 2), ("C++", 1)]
    assert rows(out["ranking_from_index"]) == [("Java", 2), ("C++", 1)]
    assert rows(out["ranking"])[:2] == [("Java", 2), ("C++", 1)]
    titles = dict(rows(out["documents"]))
    index = {r.term: sorted(titles[i] for i in r.doc_ids) for r in out["index"].collect()}
    assert index == {"Java": ["Alpha", "Beta"], "C++": ["Alpha"]}
    assert sorted((r.term, r.title) for r in out["index_articles"].collect()) == \
        [("C++", "Alpha"), ("Java", "Alpha"), ("Java", "Beta")]


def test_cluster_postings_flow(spark, tmp_path):
    path = tmp_path / "postings.csv"
    path.write_text("\n".join(LINES) + "\n")
    model = flows.cluster_postings(spark, str(path), ["Java", "PHP"], KMeansParams(spread=50000, k=2))
    assert model.initial == [(0, 7), (50000, 0)]
    assert model.fit.iterations == 1 and model.fit.centres == [(0, 7), (50000, 0)]
    assert rows(model.summary) == [("PHP", 100.0, 1, 0), ("Java", 100.0, 1, 7)]
    assert rows(model.report)[0] == ("      0  PHP               (100.0%)       1",)


def test_time_usage_flow(spark, tmp_path):
    path = tmp_path / "atus.csv"
    path.write_text(SURVEY_CSV)
    out = flows.time_usage_by_life_period(spark, str(path))
    assert rows(out["grouped"]) == rows(out["grouped_sql"]) == rows(out["grouped_typed"])
    assert out["summary"].count() == 5


def test_small_spread_samples_uniformly(spark):
    from pyspark.sql import functions as F
    vectors = spark.range(0, 50).select(F.col("id"), (F.col("id") % 2 * 100).cast("int").alias("x"),
                                         (F.col("id") % 5).cast("int").alias("y"))
    centres = flows.initial_centres(vectors, n_langs=2, k=4, seed="42:", spread=100)
    assert len(centres) == 4 and [c[0] for c in centres] == sorted(c[0] for c in centres)
    with pytest.raises(ValueError):
        flows.initial_centres(vectors, n_langs=2, k=3, seed="42:", spread=100)


def test_short_stratum_fails_initial_centres(spark):
    vectors = spark.createDataFrame([(1, 0, 5), (2, 0, 6), (3, 50000, 7)], "id long, x int, y int")
    with pytest.raises(RuntimeError, match="too few"):
        flows.initial_centres(vectors, n_langs=2, k=4, seed="42:")


@pytest.mark.parametrize("line,message", [
    ("1,50,,,0,Cobol", "without a known language"), ("1,50,,,0,", "without a known language"),
    ("2,60,,,4", "answer without parent")])
def test_strict_flow_fails_where_a_lenient_one_counts(spark, tmp_path, line, message):
    from pyspark.errors import PySparkException

    path = tmp_path / "postings.csv"
    path.write_text("\n".join([*LINES, line, "2,61,,50,4"] if line.startswith("1") else [*LINES, line]) + "\n")
    params = KMeansParams(spread=50000, k=2)
    with pytest.raises(PySparkException, match=message):
        flows.cluster_postings(spark, str(path), ["Java", "PHP"], params)
    model = flows.cluster_postings(spark, str(path), ["Java", "PHP"], params, mode="lenient")
    counts = model.left_out.first()
    assert counts["answers_without_parent"] + counts["questions_without_language"] >= 1
    model.close()


def test_fit_tells_convergence_from_the_cap(spark):
    from kestrel.operators import kmeans

    points = spark.createDataFrame([(0, 0, 1), (0, 100, 1), (0, 40, 1)], "x int, y int, n long")
    assert kmeans.fit(points, [(0, 0), (0, 1)]).converged
    assert not kmeans.fit(points, [(0, 0), (0, 1)], max_iterations=1).converged
