import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import bytewords

PATTERNS = [(bytewords.WORD_BYTES, rb"[^\x20\x09-\x0D]+"), (bytewords.TERM_BYTES, rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")]


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
@pytest.mark.parametrize(("kind", "pattern"), PATTERNS)
def test_words(monkeypatch, piece, kind, pattern):
    monkeypatch.setattr(bytewords, "PIECE", piece)
    draw = random.Random(piece)
    texts = ["".join(draw.choice("aAbZ09 \t\n\x0b\x1f\x00-_é😀") for _ in range(draw.randint(0, 80))) for _ in range(300)]
    texts += [None, "", " ", "x" * 10_000, "a", "A", "é" * 5000 + " b"]
    column = pa.array(["before", *texts])[1:]
    hashes, counts = bytewords.word_hashes(*bytewords.column_bytes(column), kind)
    names, k = {}, 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        words = re.findall(pattern, (t or "").encode().lower())
        assert n == len(words)
        for w, h in zip(words, hashes[k : k + n].tolist(), strict=True):
            assert names.setdefault(w, h) == h
        k += n
    assert k == len(hashes) and len(set(names.values())) == len(names) > 100


def test_nothing():
    for column in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        hashes, counts = bytewords.word_hashes(*bytewords.column_bytes(column), bytewords.WORD_BYTES)
        assert not len(hashes) and np.array_equal(counts, [0] * len(column))
