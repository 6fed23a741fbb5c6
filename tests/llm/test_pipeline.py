import re

import corpus_pipeline
from tablewright.llm import base, fmindex
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_pii import brute as personal


def test_stages_and_rows(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontaminate", "personal_data", "piece_ids"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    first = {i for i, (_, c) in groups(rows).items() if i == c}
    items = {w for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in fmindex.windows(fmindex.words_of(r.text))}
    word = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().lower())
    clean = {i for i, t in rows if i in first and not any(w in items for w in fmindex.windows(word(t)))}
    assert 0 < len(clean) < len(first) < docs.count()
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(clean) and all(r.same_text for r in out)
    texts = dict(rows)
    redacted = corpus_pipeline.personal_data(spark, kept, sf).collect()
    assert all((r.text != texts[r.doc_id]) >= bool(personal(texts[r.doc_id])) and not personal(r.text) for r in redacted)
    assert redacted[0].asDict().keys() == docs.first().asDict().keys()


def test_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, "/root/testdata/sf0.001")
        assert name == "piece_ids" or out.columns == odd_docs.columns
        assert out.count() <= odd_docs.count() and stage(spark, no_docs, "/root/testdata/sf0.001").count() == 0


def test_one_python_step_a_task(spark, odd_docs):
    """Two Python steps in one task are two workers, each with the memory of its operator, and both stay for the stages after it."""
    for name, stage in corpus_pipeline.STAGES:
        plan = stage(spark, odd_docs, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert name == "near_duplicates" or plan.count("ArrowEvalPython") <= 1, name


def test_workers_give_back_what_the_operator_before_left(monkeypatch):
    freed = []
    monkeypatch.setattr(base, "no_cache", lambda: freed.append(1) or base._held.clear())
    base._held.clear()
    assert [base.worker_cache(k, lambda: 7) for k in ("a", "a", "b")] == [7, 7, 7] and len(freed) == 2
    base._held.clear()


def test_ids_are_read_back_in_the_step_that_makes_them(spark, odd_docs, monkeypatch):
    """A second Python step would be a second stage over a stored copy, beside the workers of the first."""
    stored = []
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: stored.append(name) or df)
    plan = corpus_pipeline.piece_ids(spark, odd_docs, "")._jdf.queryExecution().optimizedPlan().toString()
    assert stored == [] and plan.count("ArrowEvalPython") == 1
