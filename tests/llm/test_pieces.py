import itertools

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tablewright.llm import pieces
from tablewright.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  two  spaces ", "日本 語 😀 \t x\n\ny", "é ñandú", "x" * 700, "a" + " " * 37 + "b   ", "aaaaaaaaaaaaa abababab nnnn", "hello\r\n\tworld", "ña" * 300, "3.14 1,000 l'été"]


def ids(model, text):
    with np.errstate(over="ignore"):
        return np.frombuffer(model.encode([text])[0], "<u4").tolist()


def test_equal_to_the_library(spark):
    model, library = pieces.piece_model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for t in ODD + texts:
        assert ids(model, t) == library.encode(t), t[:50]
        with np.errstate(over="ignore"):
            assert model.decode(model.encode([t])[0]) == t


def test_unigram_scores_are_the_best_of_all_ways():
    with np.errstate(over="ignore"):
        model = pieces.PieceModel(PATH, merges=False)
    for word in ("the", "tion", "abcab", "hello"):
        text = pieces.SPACE + word
        best = -np.inf
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
            parts = [text[a:b] for a, b in itertools.pairwise(at)]
            if all(p in model.score_of for p in parts):
                best = max(best, sum(model.score_of[p] for p in parts))
        score = {i: model.score_of[p] for p, i in model.id_of.items()}
        assert sum(score[i] for i in ids(model, word)) == best


def test_columns(odd_docs, no_docs):
    df = odd_docs.withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(1))
    back = pieces.with_text(pieces.with_ids(df, PATH), PATH).select("doc_id", "text", "ids", "decoded").collect()
    assert len(back) == odd_docs.count() and all(r.decoded == (r.text or "") for r in back)
    assert pieces.with_ids(no_docs, PATH).count() == 0


def test_query(spark):
    assert QUERIES["op8_pieces"](spark, "/root/testdata/sf0.001").where("not same_text").count() == 0


def test_a_batch_goes_back_in_runs():
    """A worker holds the ids or the text of about TOGETHER characters, not of a whole Arrow batch."""
    rows = [None, "", *["one two three " * 20_000] * 12, None]
    parts = list(pieces._encoder(PATH, True)(iter([pa.array(rows, pa.string()), pa.array([], pa.string()), pa.array(["x"])])))
    assert sum(map(len, parts)) == len(rows) + 1 and max(len(p) for p in parts) <= 6
    back = list(pieces._decoder(PATH)(iter([pa.array([x.as_py() for p in parts for x in p] + [None], pa.binary())])))
    assert max(len(p) for p in back) < 12 and [x.as_py() for p in back for x in p] == [t or "" for t in rows] + ["x", None]


def test_round_trip_is_one_python_step(spark, odd_docs, no_docs):
    """Two steps in one task are two workers that change roles between tasks: each then makes the model anew."""
    both = pieces.with_text(pieces.with_ids(odd_docs, PATH), PATH)
    back = pieces.round_trip(odd_docs.withColumn("decoded", F.lit(1)), PATH).select(both.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, both.collect()))
    assert pieces.round_trip(no_docs, PATH).count() == 0
    plan = QUERIES["op8_pieces"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_pieces_are_found_by_bucket():
    """Single characters have neighbouring hashes; they must not fill one bucket."""
    model = pieces.piece_model(PATH)
    with np.errstate(over="ignore"):
        assert (model._places(model.keys) == np.arange(model.none)).all() and (model._places(model.keys ^ np.uint64(1 << 63)) == model.none).all()
    run = longest = 0
    for more in model.goes_on.tolist():
        run = run + 1 if more else 0
        longest = max(longest, run)
    assert longest < 8


def test_words_kept_are_few():
    """Two workers an executor hold them beside whatever the stages before left in its memory."""
    with np.errstate(over="ignore"):
        model = pieces.PieceModel(PATH)
        for a in range(0, 160_000, 10_000):
            model.encode([" ".join(map(str, range(a, a + 10_000)))])
    assert len(model.known) + len(model.older) <= 2 * 60_000
