"""The stages one after another against plain Python, and the whole run."""

import numpy as np
from test_near_dedup import brute_classes, rare_and_common

import corpus_pipeline
from arealis.llm import mixing, packing, quality
from arealis.sources.scratch import materialize

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, FOLDER))
        seen[name] = (before.collect(), docs.collect())
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    for before, after in list(seen.values())[:3]:
        assert set(map(tuple, after)) <= set(map(tuple, before))

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = seen["quality classifier"]
    kept = {r.doc_id for r in after}
    judged = [(r.doc_id in kept) == bool(labels[r.doc_id]) for r in before if r.doc_id in labels]
    assert np.mean(judged) >= 0.9

    before, after = seen["exact dedup"]
    best = {}
    for r in before:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in after} == set(best.values()) and len(after) == len(best)

    before, after = seen["MinHash near-dedup"]
    assert {r.doc_id for r in after} == {min(c) for c in brute_classes([(r.doc_id, r.text) for r in before])}

    before, after = seen["mixing sources"]
    times = {r.doc_id: 0 for r in before}
    for r in after:
        times[r.doc_id] += 1
    assert max(times.values()) <= mixing.REPEATS
    size = {r.doc_id: len(r.text.split()) for r in before}
    assert sum(size[i] * n for i, n in times.items()) <= 1.5 * sum(size.values())

    before, after = seen["best-fit packing"]
    assert sorted(r.doc_id for r in after if r.piece == 0) == sorted(r.doc_id for r in before)
    bins = {}
    for r in after:
        bins[r.sequence_id] = bins.get(r.sequence_id, 0) + r.length
        assert len(r.ids) == 4 * r.length
    assert max(bins.values()) <= packing.CAPACITY
    assert len(bins) <= -(-sum(bins.values()) // packing.CAPACITY) + 1


def test_run_of_awkward_tables(spark, awkward, nothing, marks, tmp_path):
    for name, docs in (("awkward", awkward), ("nothing", nothing)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        marks.write.parquet(f"{folder}/labels.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    assert quality.THRESHOLD == 0.3


def test_near_duplicates_by_document_frequency(spark):
    rows = rare_and_common()
    kept = corpus_pipeline.near_deduplication(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER)
    assert {key for key, _ in rows} - {r.doc_id for r in kept.collect()} == {1}
