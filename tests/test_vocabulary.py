import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.operators import text as T
from tablewright.operators.text import fit_vocabularies


def wanted(texts, k, min_df):
    totals = Counter(w for t in texts for w in t.split())
    within = Counter(w for t in texts for w in set(t.split()))
    best = sorted((-n, w) for w, n in totals.items() if within[w] >= min_df)[:k]
    return sorted(w for _, w in best), within


@pytest.mark.parametrize(("summary", "min_df"), [(20_000, 1), (20_000, 3), (12, 1), (12, 4)])
def test_two_columns_of_skewed_and_flat_terms(spark, monkeypatch, summary, min_df):
    """Small summaries lose counts and leave cuts unproven at first; the result is the same."""
    monkeypatch.setattr(T, "SUMMARY_TERMS", summary)
    monkeypatch.setattr(T, "SUMMARY_SHARE", 1)
    draw = random.Random(summary + min_df)
    rows = []
    for i in range(300):
        skewed = [f"w{int(draw.paretovariate(0.7)) % 500:03d}" for _ in range(20)]
        flat = [f"f{draw.randint(0, 399):03d}" for _ in range(8)] + (["burst"] * 40 if i == 7 else [])
        rows.append((" ".join(skewed), " ".join(flat)))
    df = spark.createDataFrame(rows, "a string, b string").repartition(6)
    for k, v in enumerate(fit_vocabularies(df, [F.col("a"), F.col("b")], 12, min_df)):
        terms, within = wanted([r[k] for r in rows], 12, min_df)
        assert v.terms == terms and v.containing == [within[t] for t in terms] and v.documents == 300


def test_nulls_and_few_terms(spark):
    df = spark.createDataFrame([("aa bb aa", None), (None, None), ("", "cc")], "a string, b string")
    a, b = fit_vocabularies(df, [F.col("a"), F.col("b")], 100)
    assert (a.terms, a.containing, a.documents, b.terms) == (["aa", "bb"], [1, 1], 3, ["cc"])
    with pytest.raises(ValueError, match="empty vocabulary"):
        fit_vocabularies(df, [F.col("b"), F.lit("x")], 100)


def test_summary_bounds():
    draw = random.Random(1)
    words = [f"w{int(draw.paretovariate(0.5)) % 900}" for _ in range(20_000)]
    s = T.Summary({})
    for at in range(0, len(words), 100):
        s.add(pa.array(words[at : at + 100]), 40)
    exact = Counter(words)
    assert len(s.counts) <= 180 and 0 < s.error <= len(words) / 40
    assert all(s.counts.get(w, 0) <= n <= s.counts.get(w, 0) + s.error for w, n in exact.items())


def test_terms_are_looked_at_in_runs_of_whole_texts(spark, monkeypatch):
    """However many texts Spark sends together, a task's arrays are those of a run."""
    texts = pa.array([["a", "b"], [], ["c"] * 7, ["d"], ["e", "f"], []], pa.list_(pa.string())).slice(1)
    runs = [r.to_pylist() for r in T.in_runs(texts, 3)]
    assert [len(r) for r in runs] == [1, 1, 3] and sum(runs, []) == texts.to_pylist()
    assert [*T.in_runs(texts.slice(0, 0), 3)] == []

    monkeypatch.setattr(T, "TOGETHER", 50)
    rows = [(f"w{i % 7:02d} " * (1 + i % 90) + f"x{i}",) for i in range(400)]
    found = fit_vocabularies(spark.createDataFrame(rows, "a string").coalesce(1), [F.col("a")], 7)[0]
    terms, within = wanted([r[0] for r in rows], 7, 1)
    assert found.terms == terms and found.containing == [within[t] for t in terms] and found.documents == 400
