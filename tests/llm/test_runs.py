import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from tablewright.llm import runs
from tablewright.llm.queries import QUERIES


def brute(words, least=6, times=4):
    """All runs by trying every period: stretches of words[i] == words[i + q], whose smallest period q is."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, times * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def test_words_out_of_few():
    draw = random.Random(3)
    docs = [[draw.choice("ab" if k % 2 else "abc") for _ in range(draw.randint(0, 60))] for k in range(600)]
    docs += [list("ab" * 30 + "c" + "ab" * 30), list("aab" * 20), ["a"] * 500, list("abaab" * 8 + "abaababaab" * 6), []]
    got = runs.runs_of(docs)
    for words, found in zip(docs, got, strict=True):
        assert found == [(s, n, q) for s, n, q in sorted(brute(words), key=lambda r: (r[0], r[2]))]
    assert sum(map(len, got)) > 100


@pytest.mark.parametrize(("least", "times"), [(1, 2), (4, 2), (10, 3), (6, 5)])
def test_other_bounds(least, times):
    draw = random.Random(least)
    docs = [[draw.choice("ab") for _ in range(50)] for _ in range(100)] + [list("abc" * 9 + "x" + "abc" * 4)]
    for words, found in zip(docs, runs.runs_of(docs, least, times), strict=True):
        assert sorted(found) == brute(words, least, times)


def test_long_runs():
    draw = random.Random(8)
    period = [str(draw.random()) for _ in range(700)]
    assert runs.runs_of([period * 10, ["longword"] * 100_000, period * 3]) == [[(0, 7000, 700)], [(0, 100_000, 1)], []]


def test_odd_rows(odd_docs, no_docs):
    out = runs.with_runs(odd_docs)
    assert out.columns == [*odd_docs.columns, "runs"] and out.count() == odd_docs.count()
    for r in out.collect():
        words = (r.text or "").encode().split()
        want = brute(words) if len(words) < 2000 else [(0, len(words), 1)]
        assert [tuple(x) for x in r.runs.runs] == want and r.runs.n_words == len(words)
        assert r.runs.collapsed == b" ".join(collapse(words, want)).decode()
    assert runs.with_runs(no_docs).count() == 0
    clash = runs.with_runs(odd_docs.withColumnRenamed("ledger", "runs"))
    assert clash.columns == [c if c != "ledger" else "runs" for c in odd_docs.columns] and clash.first().runs.n_words == 200


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_runs"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    looped = 0
    for i, t in texts.items():
        words, h = (t or "").encode().split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            looped += 1
        found = sorted(brute(words), key=lambda r: (r[0], r[2]))
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(collapse(words, found))).hexdigest()
    assert looped > 5
