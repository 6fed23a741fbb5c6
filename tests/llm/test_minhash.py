import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import linking, minhash
from tablewright.llm.queries import QUERIES
from tests.llm import test_jaccard


def brute(rows, size=4):
    """(id -> set size, smallest linked id), from word tuples and all pairs that share one."""
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    sets = {i: {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()) for i, w in words.items()}
    at = {}
    for i, s in sets.items():
        for g in s:
            at.setdefault(g, []).append(i)
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in {p for same in at.values() for p in combinations(sorted(same), 2)}:
        n = len(sets[a] & sets[b])
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            top[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    return want


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_sets():
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randint(0, 30))) for _ in range(200)] + [None, "A b C d", "a B c D"]
    sets = minhash.sets_of(pa.array(texts))
    for t, s in zip(texts, sets, strict=True):
        assert brute([(0, t)])[0][0] == len(s) and np.array_equal(s, np.unique(s))
    assert np.array_equal(sets[-1], sets[-2])
    assert all((brute([(0, t), (1, u)])[1][1] == 0) == bool(_both(s, r)) for (t, s), (u, r) in combinations(list(zip(texts, sets))[::7], 2))


def _both(s, t):
    n = len(np.intersect1d(s, t))
    return n and 100 * n >= 80 * (len(s) + len(t) - n)


@pytest.mark.parametrize("stretch", [100, 1 << 15])
def test_signatures(monkeypatch, stretch):
    """Coordinate k is the smallest place in the second order after k steps; shares of equal coordinates are near the similarity."""
    monkeypatch.setattr(minhash, "STRETCH", stretch)
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 900).astype(np.uint64)
    sets = [np.sort(base[:n]) for n in (900, 720, 450)] + [np.empty(0, np.uint64), base[:1]]
    got = minhash.signatures(sets, 400)
    for row, s in zip(got, sets, strict=True):
        for k in (0, 1, 17):
            x = ((minhash.mix(s ^ minhash._SEED) >> np.uint64(32)) + np.uint64(k * int(minhash.STEP))).astype(np.uint32)
            minhash._second_permutation(x, np.empty_like(x))
            assert row[k] == (x.min() if len(x) else 0xFFFFFFFF)
    assert abs((got[0] == got[1]).mean() - 0.8) < 0.08 and abs((got[0] == got[2]).mean() - 0.5) < 0.1


def chain(draw, words, n, keep):
    out = []
    for _ in range(n):
        words = [w if draw.random() < keep else f"n{draw.random()}" for w in words]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("part", [2000, 16 << 20])
def test_families(spark, monkeypatch, part):
    """Chains of copies, many copies of one text at all similarities, texts of little but a shared passage; small and large parts."""
    monkeypatch.setattr(minhash, "PART", part)
    draw = random.Random(5)
    texts = [t for f in range(8) for t in chain(draw, [f"f{f}w{k}" for k in range(draw.randint(40, 200))], 15, 0.985)]
    base = [f"b{k}" for k in range(100)]
    for _ in range(150):
        share = draw.choice([0.005, 0.02, 0.04])
        texts.append(" ".join(w if draw.random() > share else f"m{draw.random()}" for w in base))
    passage = [f"p{k}" for k in range(60)]
    texts += [" ".join(passage + [f"q{j}k{k}" for k in range(draw.randint(0, 30))]) for j in range(80)]
    order = list(enumerate(texts))
    draw.shuffle(order)
    want = check(spark.createDataFrame(order, "doc_id long, text string").repartition(5))
    assert len({c for _, c in want.values()}) > 20


def test_second_look_gives_linear_rows():
    """Copies whose pairs are all similar, each in a group of its own: the links given are fewer than the copies."""
    draw = np.random.default_rng(0)
    base, rows = draw.integers(0, 2**63, 400).astype(np.uint64), {}
    for m in (40, 160):
        sets = [np.sort(np.concatenate([base[:380], draw.integers(0, 2**63, 20).astype(np.uint64)])) for _ in range(m)]
        ids = np.arange(m)
        table = pa.table({"key": np.zeros(m, int), "i": np.zeros(m, int), "j": np.zeros(m, int), "part": np.zeros(m, int), "id": ids, "component": ids, "s": pa.array([s.tobytes() for s in sets], pa.binary())})
        rows[m] = len(linking.joining_links(table)[0])
    assert rows == {40: 39, 160: 159}


def test_brute_agrees():
    rows = [(k, " ".join(f"w{j}" for j in range(k, k + 30))) for k in range(40)]
    assert brute(rows, 5) == test_jaccard.brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op11_minhash"](spark, sf).collect()} == want


def test_no_query_copies_its_inputs(odd_docs, monkeypatch):
    """The driver plans a query anew after each of its stages, all copies of a part that is read more than once included."""
    joins, store = {}, minhash.stored

    def counted(df, name):
        joins[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return store(df, name)

    monkeypatch.setattr(minhash, "stored", counted)
    check(odd_docs)
    assert joins["near"] <= 2 and max(joins.values()) <= 4, joins
