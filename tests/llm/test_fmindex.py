import random

import numpy as np
from pyspark.sql import functions as F

from tablewright.llm import fmindex


def test_index_against_scanning():
    draw = random.Random(4)
    for _ in range(20):
        s = np.array([draw.randint(1, 5) for _ in range(draw.randint(1, 300))] + [0])
        index = fmindex.FMIndex(s)
        assert fmindex.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        for m in (1, 2, 5):
            p = np.array([[draw.randint(1, 6) for _ in range(m)] for _ in range(10)])
            low, high = index.search(p, np.full(10, m))
            for k in range(10):
                want = [i for i in range(len(s) - m + 1) if s[i : i + m].tolist() == p[k].tolist()]
                assert sorted(index.locate(np.arange(low[k], max(low[k], high[k]))).tolist()) == want


def test_spans_items_and_odd_rows(spark, odd_docs, no_docs):
    a, b = " ".join(f"a{k}" for k in range(14)), "one two three"
    items = spark.createDataFrame([("i2", a), ("i1", b), ("i1", b), ("i3", None), ("i4", " , "), (None, a)], "item_id string, text string")
    rows = [(1, f"x {a} y"), (2, f"{a.upper()} {a}"), (3, "One, two. THREE four"), (4, "one two"), (5, " ".join(a.split()[:9])), (6, None), (7, f"one two\n three {b}"), (1, f"x {a} y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("leak", F.lit(1))
    got = {r.doc_id: r.leak for r in fmindex.with_spans(df, items).collect()}
    flat = {i: (list(zip(x.starts, x.ends, strict=True)), x["items"]) for i, x in got.items()}
    assert flat == {1: ([(1, 15)], ["i2"]), 2: ([(0, 28)], ["i2"]), 3: ([(0, 3)], ["i1"]), 4: ([], []), 5: ([], []), 6: ([], []), 7: ([(0, 6)], ["i1"])}
    assert got[6].n_words == 0 and got[3].n_words == 4
    assert fmindex.removed(rows[0][1], [1], [15]) == "x  y"
    assert fmindex.with_spans(odd_docs, items.where("false")).where("size(leak.starts) > 0").count() == 0
    assert fmindex.with_spans(odd_docs, items).count() == odd_docs.count() and fmindex.with_spans(no_docs, items).count() == 0


def test_blocks_of_phrases_and_shards(spark, monkeypatch):
    monkeypatch.setattr(fmindex, "PHRASE_WORDS", 3)
    items = spark.createDataFrame([(f"i{k}", " ".join(f"k{k}w{j}" for j in range(12))) for k in range(5)], "item_id string, text string")
    text = " ".join(r.text for r in items.collect())
    row = fmindex.with_spans(spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string"), items).where("doc_id = 1").first().leak
    assert (row.starts, row.ends, row["items"]) == ([0], [60], ["i0", "i1", "i2", "i3", "i4"])
