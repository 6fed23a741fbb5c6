from tablewright.llm import quality


def test_ledger(odd_docs, no_docs):
    rows = quality.with_ledger(odd_docs).select("doc_id", "ledger", quality.broken("base").alias("b")).collect()
    assert len(rows) == odd_docs.count() and all(r.b for r in rows if r.doc_id in (9, 10, 11, 12, 13))
    assert not any(r.b for r in rows if r.doc_id in (1, 2, 3, 5))
    assert quality.with_ledger(no_docs).count() == 0


def test_repeat_words():
    assert quality.repeat_words("a b c x a b c".split()) == 6
    assert quality.repeat_words("a a a a".split()) == 4
    assert quality.repeat_words("a b c d".split()) == quality.repeat_words([]) == 0


def test_ablation(odd_docs, no_docs):
    held = quality.with_ledger(odd_docs)
    bits = [r.ledger.failed for r in held.select("ledger").collect()]
    for r in quality.ablation(held, "v2").collect():
        assert (r.n_broken, r.n_alone, r.n_kept_without, r.n_documents) == (sum(b & r.bit > 0 for b in bits), sum(b == r.bit for b in bits), sum(b & ~r.bit == 0 for b in bits), len(bits))
    assert [r.n_documents for r in quality.ablation(quality.with_ledger(no_docs), "base").collect()] == [0, 0]


def test_labels(spark):
    """On labelled documents the current policy rejects all poor ones, and of the good ones only those that the base rules reject."""
    sf = "/root/testdata/sf0.01"
    df = quality.with_ledger(spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id"))
    rows = df.select("quality", quality.broken("base").alias("base"), quality.broken().alias("now")).collect()
    assert all(r.now for r in rows if r.quality == 0) and all(r.base for r in rows if r.quality == 1 and r.now)
