import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm import tokens
from tablewright.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "don't stop, it's <|endoftext|> x", "<|ENDOFTEXT|>", "a\x1cb c", "é x", "İstanbul ΣΑΣ", "x_y, 12½ ² “q”… a–b", "\xa0 a", "a.,b!? c++ d--e", "Ⅷ नमस्ते", "word" * 500]


@pytest.fixture(scope="module")
def direct():
    t = Tokenizer.from_file(PATH)
    return lambda text: np.asarray(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_are_the_librarys(direct):
    assert tokens.tokenizer_cache(PATH).serialized(ODD) == [direct(t) for t in ODD]
    assert tokens.tokenizer_cache(PATH).serialized([None]) == [b""]


def test_random_strings(direct):
    """Letters whose lower case is more than a letter, marks, and letters that Unicode tables know differently, beside signs."""
    draw = random.Random(11)
    letters, signs = "aZéİßΣςᲉᲊꟲ̇́ж漢ⅷ½²_9", ".,;:!?'\"()-/«»…—“ \t\xa0\u200b"
    some = ["".join(draw.choice(draw.choice((letters, signs, "abcXYZ İ.,"))) for _ in range(draw.randint(1, 14))) for _ in range(50_000)]
    some += ["ALİ.", "VALİ, geldi", "(Lİ)", "nasılsın ALİ?"]
    assert tokens.tokenizer_cache(PATH).serialized(some) == [direct(t) for t in some]


def test_segment():
    docs = [(None, b"", 0), (3, b"abc", 1), (9, b"", 0)]
    import zstandard

    packed = tokens.pack([(i, zstandard.compress(d), n) for i, d, n in docs], b"")
    s = tokens.Segment(packed, b"")
    assert [s.document(i) for i in range(3)] == [b"", b"abc", b""] and s.find(3) == b"abc" and s.find(4) is None and s.find(0) is None
    with pytest.raises(ValueError):
        tokens.Segment(packed, b"another dictionary")


def test_round_trip(odd_docs, no_docs, direct):
    rows = tokens.round_trip(odd_docs, PATH).collect()
    want = sorted(((r.doc_id if r.doc_id is not None else -1), direct(r.text or "") + b"\1\0\0\0") for r in odd_docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in rows) == want
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    assert tokens.round_trip(no_docs, PATH).count() == 0


def test_query(spark, direct):
    rows = {r.doc_id: r for r in QUERIES["op3_tokens"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect():
        ids = direct(r.text or "") + b"\1\0\0\0"
        assert tuple(rows[r.doc_id]) == (r.doc_id, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
