import re
from collections import defaultdict

import corpus_pipeline
from kestrel.llm import decontam, mixing, pii, quality
from tests.llm.edge import edge_frame, empty_frame
from tests.llm.test_mixing import brute_targets, size_of
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF001 = "/root/testdata/sf0.001"


def test_run_equals_the_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    rows = [r for r in docs.collect() if r.doc_id in kept]
    marks = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    rows = [r for r, c in zip(rows, brute_components(marks)) if r.doc_id == c]
    index = decontam.build_index([(b.item_id, b.text) for b in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()])
    rows = [r for r in rows if not index.hits(r.text)]
    automaton = pii.anchors()
    sizes = {r.doc_id: (r.source, size_of(pii.mask(r.text, pii.find_spans(r.text, automaton)))) for r in rows}
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id: (r.source, r["size"]) for r in got} == sizes and len(got) == len(sizes)
    held = defaultdict(int)
    for source, size in sizes.values():
        held[source] += size
    targets, taken = brute_targets(dict(held)), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 0.5 + 1e-6 for s, t in targets.items())


def test_stages_handle_edges(spark):
    for frame in (edge_frame(spark), empty_frame(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF001)
            if name != "mix_sources":
                assert out.columns == frame.columns, name
            out.collect()
    assert mixing.mix(empty_frame(spark)).documents().collect() == []


def test_masked_text_and_length(spark):
    docs = spark.createDataFrame([(1, "mail a.b@example.com now", 24), (2, None, None), (3, "plain", 5)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs).collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: (None, None), 3: ("plain", 5)}
    assert not re.search("@", got[1][0])
