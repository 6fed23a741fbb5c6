import numpy as np
from pyspark.sql import functions as F

from tablewright.llm import licenses


def longest(a, b):
    """The longest common subsequence, without a band."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_full_notices_lines_and_edits(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    words = mit.split()
    edited = " ".join(["Some"] * 5 + words[:20] + ["of", "the"] + words[24:] + ["more"] * 5)
    rows = [(1, "x " + mit + " y"), (2, edited), (3, "Text.\nReleased under the MIT License.\nÜ 😀 licensed under the apache license version 2.0!"), (4, "the software is free"), (5, None), (6, ""), (7, "under the " * 50_000), (3, "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(1))
    got = {}
    for r in licenses.with_licenses(df).collect():
        got.setdefault(r.doc_id, []).append([(x.license, r.text[x.start : x.end]) for x in r.licenses])
    assert [x for x, _ in got[1][0]] == ["MIT"] and got[1][0][0][1].startswith("Permission is") and got[1][0][0][1].endswith("NONINFRINGEMENT")
    assert [x for x, _ in got[2][0]] == ["MIT"]
    assert sorted(got[3]) == [[("MIT", "Released under the MIT License")], [("MIT", "Released under the MIT License"), ("Apache-2.0", "licensed under the apache license version 2.0")]]
    assert got[4] == got[5] == got[6] == got[7] == [[]]
    assert licenses.with_licenses(df.where("false")).count() == 0


def test_alignment_against_full_matrix():
    index = licenses.TemplateIndex(licenses.TEMPLATES)
    draw = np.random.default_rng(1)
    for t, w in enumerate(index.words):
        text = w[draw.random(len(w)) > 0.08]
        ids = np.concatenate([np.zeros(7, np.int64), text, np.zeros(5, np.int64)])
        m = index.align(ids, t, 7, 7)
        assert m.matched == longest(w.tolist(), ids.tolist())


def test_notices_close_together():
    """Every copy of a notice repeated within a band is found, also beside a part of it."""
    index = licenses.TemplateIndex(licenses.TEMPLATES)

    def found(text):
        return [(m.license, m.start, m.end) for m in index.scan(np.array([index.vocabulary.get(w, 0) for w in licenses.words_of(text)], np.int64))]

    for line, name in (("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), (licenses.TEMPLATES["ISC"][0], "ISC"), (licenses.TEMPLATES["MIT"][2], "MIT")):
        n = len(licenses.words_of(line))
        for gap in (0, 1, 5):
            for copies in (2, 3, 60):
                got = found(("zz " * gap + line + " ") * copies)
                assert got == [(name, k * (n + gap) + gap, (k + 1) * (n + gap)) for k in range(copies)]
    full = "Licensed under the Apache License, Version 2.0."
    part = "Licensed under the Apache License"
    assert found(f"{part} zz zz zz {full}") == [("Apache-2.0", 8, 16)]
    assert found(f"{full} zz zz zz {part} zz {full}") == [("Apache-2.0", 0, 8), ("Apache-2.0", 17, 25)]
    words = licenses.TEMPLATES["ISC"][0].split()
    edited = " ".join(words[:10] + ["zz"] + words[11:20] + words[21:])
    assert found(" ".join([*words[:9], "zz zz zz", edited, edited])) == [("ISC", 13, 13 + len(licenses.words_of(edited))), ("ISC", 13 + len(licenses.words_of(edited)), 13 + 2 * len(licenses.words_of(edited)))]


def test_every_planted_line(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = ["Released under the MIT License", "Licensed under the Apache License, Version 2.0", "licensed under the GNU General Public License, version 3", "Licensed under CC BY-NC 4.0"]
    has = F.lit(False)
    for x in lines:
        has = has | F.contains("text", F.lit(x))
    assert licenses.with_licenses(df).where((F.size("licenses") > 0) != has).count() == 0
