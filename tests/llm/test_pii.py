import hashlib
import random
import re

from pyspark.sql import functions as F

from tablewright.llm import pii
from tablewright.llm.queries import QUERIES

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ODD = [
    "a@b.co%x@d.e @x.y a@b a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.2.3.4", "4111 1111 1111 1111-4111-1111-1111-1111 4111111111111111", "+1 (017) 555-7713 +12 34 +1234567890123456 ++1-202-555-0100",
    "é@x.y ü1.2.3.4ß +49 30 1234567 😀 a.b@c.de", "1" * 20_000, "a.b" * 5_000 + "@c.d", "9 " * 2000, "", None, "1.2.3." * 500, "+1" + "2 " * 500, "4111111111111111", "x" * 3000,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), place, m.end(), kind))
    return sorted(out)


def test_base_spans_and_redaction(spark):
    draw = random.Random(6)
    texts = ODD + ["".join(draw.choice("0123456789 .-+()@aA_é") for _ in range(120)) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("pii", F.lit(0))
    rows = pii.with_base_spans(df).select("text", "pii", pii.redacted(F.col("text"), F.col("pii")).alias("new")).collect()
    for r in rows:
        want = brute(r.text)
        assert [(s.start, s.place, s.end, s.kind) for s in r.pii] == want
        if not want:
            assert r.new == r.text
        new, at = "", 0
        for a, _, b, kind in want:
            new, at = (new + r.text[at:a] + f"[{kind.upper()}]", b) if a >= at else (new, max(at, b))
        assert r.new == (None if r.text is None else new + r.text[at:])
    assert pii.with_base_spans(df.where("false")).count() == 0


def test_trees_add_what_looks_like_personal_data(spark):
    """Fitted where numbers with a plus are phones and other numbers are not; held-out accuracy, and phones written without a plus."""
    draw = random.Random(8)
    d = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(600):
        rows.append((i, f"words here +1 ({d(3)}) {d(3)}-{d(4)} and order {d(4)}-{d(7)} end, item {d(13)}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    assert model.trees and model.threshold < 4
    new = spark.createDataFrame([(1, f"call ({d(3)}) {d(3)}-{d(4)} today"), (2, f"order {d(4)}-{d(7)} end"), (3, None), (4, "me@x.org")], "doc_id long, text string")
    got = {r.doc_id: pii_list(r.pii.spans) for r in pii.with_spans(new, model).collect()}
    assert got == {1: ["phone:5:19"], 2: [], 3: [], 4: ["email:0:8"]}


def pii_list(spans):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans]


def test_nothing_to_learn_from(odd_docs, no_docs):
    assert pii.fit(odd_docs) == pii.SpanModel() == pii.fit(no_docs)
    assert pii.with_spans(odd_docs, pii.SpanModel()).count() == odd_docs.count()


def test_native_and_query(spark, capsys):
    sf = "/root/testdata/sf0.001"
    df = QUERIES["op10_pii"](spark, sf)
    df.explain()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", capsys.readouterr().out)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in df.collect():
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_trees_learn_from_every_text(spark):
    """Each of 4,100 texts has one candidate; long texts have some too."""
    texts = [f"call +1 202 555 {i:04d} now" if i % 2 else f"order {i:04d}-1234567 end" for i in range(4100)]
    texts += [f"{'x ' * 40_000} call +1 303 555 {i:04d}" for i in range(3)]
    seen = []
    kept = pii.cut_lineage
    pii.cut_lineage = lambda df: seen.append(kept(df)) or seen[-1]
    try:
        pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    finally:
        pii.cut_lineage = kept
    assert seen[0].select("_h").distinct().count() == len(texts)
