from collections import Counter, defaultdict
from itertools import combinations
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import jaccard, linking
from tablewright.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    """(id -> set size, smallest linked id), over word tuples and all pairs that share one."""
    sets = defaultdict(set)
    for i, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets[i] |= {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    shared = Counter()
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    for same in at.values():
        shared.update(combinations(sorted(same), 2))
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            top[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = jaccard.join_groups(df).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None])
    for r in got:
        assert r.component_id is None if r.doc_id is None else (r.n_shingles, r.component_id) == want[r.doc_id]


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert jaccard.join_groups(no_docs).count() == 0
    assert jaccard.one_of_each(no_docs).count() == 0


def test_one_of_each(odd_docs):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect())
    groups = brute([(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None])
    assert ids == sorted([(False, i) for i, (_, c) in groups.items() if i == c] + [(True, None)])


@pytest.mark.parametrize("common", [2, 10**9])
def test_families(spark, monkeypatch, common):
    """Chains of copies, texts of little but a shared passage, many sizes; with and without common shingles."""
    monkeypatch.setattr(jaccard, "COMMON_COUNT", common)
    monkeypatch.setattr(jaccard, "SAMPLED", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 90)
    draw = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for f in range(6):
        text = [f"f{f}w{k}" for k in range(draw.randint(60, 300))]
        for _ in range(12):
            text = [w if draw.random() > 0.008 else f"n{draw.random()}" for w in text]
            texts.append(" ".join(text))
    texts += [" ".join(passage + [f"q{j}k{k}" for k in range(draw.randint(0, 30))]) for j in range(110)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))


def test_common_block_of_few_classes(spark):
    """Many exact copies make all shingles common; the truncations' classes lie in salts of their own and link with each other only."""
    rows, cut = [], (104, 89, 75, 63)  # words; each shares four fifths of its shingles with the next alone
    for f in range(3):
        words = [f"f{f}w{k}" for k in range(cut[0])]
        rows += [(1000 * f + k, " ".join(words)) for k in range(300)]
        rows += [(1000 * f + 300 + k, " ".join(words[:n])) for k, n in enumerate(cut[1 : 2 + f])]
    salts = [[1 + (i * 2654435761 >> 7) % jaccard.SALTS for i, t in rows if i % 1000 in (0, 300, 301, 302) and i // 1000 == f] for f in range(3)]
    assert all(len(set(s)) == len(s) for s in salts)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_traversal_finds_every_pair():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in draw.integers(20, 400, 150)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * 0.92)], draw.integers(0, 2**63, 3).astype(np.uint64)])) for s in sets for _ in range(2)]
    n = np.array([len(s) for s in sets])
    bits = np.stack([jaccard.folded(jaccard.bitmap(s)) for s in sets])
    groups = np.arange(len(sets)) // 2
    tree = jaccard.SignatureTree(n, bits, groups)
    found = {tuple(sorted(p)) for a, b in jaccard.dual_traversal(tree, tree) for p in zip(a.tolist(), b.tolist(), strict=True)}
    for a, b in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if groups[a] != groups[b] and 100 * both >= 80 * (n[a] + n[b] - both):
            assert (a, b) in found


def test_rows_of_a_block_grow_with_its_members():
    """Near copies, each in a group of its own, all of whose pairs the bounds let through: a block gives its members once, and the exact step
    one link less than it has members."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 300).astype(np.uint64)
    for m in (100, 400):
        sets = [np.unique(np.concatenate([base[:285], draw.integers(0, 2**63, 15).astype(np.uint64)])) for _ in range(m)]
        zero, ids = np.zeros(m, np.int64), np.arange(m)
        table = pa.table({"key": zero + 9, "i": zero, "j": zero, "part": zero, "id": ids, "group": ids, "n_shingles": [len(s) for s in sets], "bits": pa.array([jaccard.bitmap(s).tobytes() for s in sets], pa.binary())})
        assert sum(b.num_rows for b in jaccard._block_members(table, np.array([0, m]))) == m
        keyed = table.append_column("keys", pa.array([[5, 9]] * m))
        assert not sum(b.num_rows for b in jaccard._block_members(keyed, np.array([0, m])))  # the block of key 5 holds them all
        whole = table.append_column("component", pa.array(ids)).append_column("s", pa.array([s.tobytes() for s in sets], pa.binary()))
        assert len(linking.joining_links(whole)[0]) == m - 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard"](spark, sf).collect()} == want


@pytest.mark.parametrize(("edges", "looks"), [([(5, 1), (1, 4), (9, 7), (5, 1)], 1), ([(1, 2), (2, 3), (3, 4)], 9), ([], 1)])
def test_components_end_when_all_is_settled(spark, monkeypatch, edges, looks):
    """Stars, as copies of one text give them, take no round; every round is several shuffles."""
    made = []
    monkeypatch.setattr(jaccard, "cut_lineage", lambda df, cut=jaccard.cut_lineage: made.append(1) or cut(df))
    top = {}
    for a, b in edges * 3:
        top[a] = top[b] = min(a, b, top.get(a, a), top.get(b, b))
    found = [tuple(r) for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(found) == sorted(top.items()) and len(made) <= looks


def test_entries_hold_every_prefix_shingle(spark):
    rng = np.random.default_rng(3)
    common = np.sort(rng.integers(0, 1 << 64, 300, np.uint64))
    sizes = {-5: 3, 0: 0, 7: jaccard.ENTRIES + 10, 8: 1, 1 << 60: 40}
    prefixes = {i: rng.choice(common, n) if n < 50 and i % 2 else rng.integers(0, 1 << 64, n, np.uint64) for i, n in sizes.items()}
    rows = [(i, 5 * len(s), bytearray(s.tobytes())) for i, s in prefixes.items()]
    got = jaccard._entries(spark.createDataFrame(rows, "id long, n_shingles long, prefix binary").coalesce(1), common).toPandas()
    assert len(got) == sum(sizes.values())
    for i, s in prefixes.items():
        own = got[got["id"] == i]
        assert sorted(own["key"]) == sorted(s.view(np.int64).tolist()) and (own["n"] == 5 * len(s)).all()
    hot = np.isin(got["key"].to_numpy(np.int64).view(np.uint64), common)
    assert hot.any() and (got["salt"][~hot] == 0).all() and got["salt"][hot].between(1, jaccard.SALTS).all()


def test_work_for_a_document_does_not_grow_with_the_common_shingles(spark):
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS i", "concat_ws(' ', 'a b c d e', id, id + 1) AS t")

    def took(common):
        start = time.monotonic()
        assert jaccard._entries(jaccard._classes(jaccard._sets(docs, common), "prefix"), common).count() == 2000
        return time.monotonic() - start

    few = took(np.empty(0, np.uint64))
    many = took(np.sort(np.random.default_rng(1).integers(0, 1 << 64, jaccard.MOST_COMMON, np.uint64)))
    assert many < few + 10  # with a pass over all common shingles for each text: minutes
