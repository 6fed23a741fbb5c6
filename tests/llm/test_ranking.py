import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import ranking

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, queries, k=20):
    """All scores of all documents, from the definition."""
    words = [(i, TERM.findall((t or "").encode().lower())) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(x for _, w in words for x in set(w))
    out = []
    for item, text in queries:
        scores = []
        for i, w in words:
            tf, score = Counter(w), 0
            for term in TERM.findall((text or "").encode().lower()):
                if tf[term]:
                    m = 100 - 25 + 25 * len(w) * n_docs // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (1000000000 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("shard", "short", "step"), [(100, 1, 1), (3000, 4, 2), (1 << 20, 16, 8), (1 << 20, 10**9, 8)])
def test_against_all_scores(spark, monkeypatch, shard, short, step):
    for name, value in (("RANGE", 4), ("SHORT", short), ("STEP", step)):
        monkeypatch.setattr(ranking, name, value)
    draw = random.Random(shard)
    vocabulary = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(vocabulary[min(59, int(draw.expovariate(0.1)))] for _ in range(n))
    docs = [(k, text(draw.randint(0, 40))) for k in range(400)] + [(k, "W1 w1-w2") for k in (900, 901, 905)]
    queries = [(f"q{k}", text(draw.randint(1, 12))) for k in range(30)] + [("none", "absent"), ("same", "w1 w1 w2"), ("same", "w1 w1 w2")]
    indexed = ranking.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard=shard)
    found = ranking.search(indexed, spark.createDataFrame(queries, "item_id string, text string"), 7)
    assert rows(found) == brute(docs, queries, 7)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranking, "QUERY_BYTES", 8)
    docs, queries = [(1, "a b c"), (2, "b c"), (3, "d")], [(7, "a b"), (8, "c c d"), (None, "d")]
    found = ranking.search(ranking.index(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(queries, "item_id long, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and rows(found) == brute(docs, queries)


def test_skips_ranges():
    """A rare term in one range: the ranges that hold only the common term are not scored."""
    n = 1280
    facts = ranking.Statistics(n, 4 * n)
    docs = [np.arange(n), np.arange(40, 60)]
    block = ranking.Block(np.array([1, 2], np.uint64), np.array([20, 9000]), [[(0, 1), (1, 1)]])
    shard = ranking.Shard(
        __import__("pyarrow").array(range(n)), np.full(n, 4), block.terms, np.array([0, n, n + 20]), np.concatenate(docs).astype(np.int32), np.ones(n + 20, np.int32), facts, block
    )
    seen, whole = [], ranking.Shard._ranges
    shard._ranges = lambda lists, ranges, floor, best: (seen.extend(ranges.tolist()), whole(shard, lists, ranges, floor, best))
    best = ranking.Best(10)
    shard.rank(block.queries[0], best)
    assert seen == [0] and best.ids.tolist() == list(range(40, 50))


def test_odd_rows(spark, odd_docs, no_docs):
    queries = [(1, "w1x1 w1x2 the"), (2, None), (3, ""), (4, "😀 ÜMLÄÜT longword"), (5, "ümläüt"), (6, "two")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in queries], "item_id long, text string, rank int, score string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows(ranking.ranked(odd_docs, asked)) == brute(docs, queries)
    assert ranking.ranked(no_docs, asked).count() == 0 and ranking.ranked(odd_docs, asked.where("false")).count() == 0
