import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tablewright.llm import chat


def least(a, kinds):
    """The cost of the best of all ways to give roles."""
    best = None
    for roles in itertools.product((1, 2, 3), repeat=len(kinds)):
        p, cost = 0, 0
        for k, q in zip(kinds, roles, strict=True):
            cost, p = cost + a.step[k][p][q], q
        best = min(x for x in (best, cost + a.end[p]) if x is not None)
    return best


@pytest.mark.parametrize("chunk", [2, 4096])
def test_least_cost_and_legal(spark, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK", chunk)
    draw = random.Random(3)
    rows = [(i, j, draw.choice(["system", "user", "assistant", "Human ", "x", None]), f"t{i}.{j}" if draw.random() < 0.9 else None) for i in range(60) for j in range(draw.randint(1, 6))]
    out = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "turn").collect()
    assert len(out) == len(rows)
    a = chat.Automaton()
    for i, turns in itertools.groupby(out, key=lambda r: r.conv_id):
        turns = list(turns)
        assert sum(r.cost for r in turns) == least(a, [chat.ALIASES.get((r.role or "").strip().lower(), 0) for r in turns])
        text = "".join(r.piece for r in turns)
        roles = re.findall(r"<\|im_start\|>(\w+)\n", text)
        assert re.fullmatch(r"(system )?(user assistant )+", " ".join(roles) + " "), roles
        assert text.count("<|im_end|>\n") == len(roles) and all(t is None or t in text for k, _, _, t in rows if k == i)


def test_actions(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "hi"), (3, 0, "user", "q"), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("x")).withColumn("c", F.lit(1))
    out = {(r.conv_id, r.turn): r for r in chat.repaired(df).where("conv_id is not null").collect()}
    assert [out[1, k].action for k in range(3)] == ["keep", "merge", "keep"] and out[1, 1].piece == "\n\nb"
    assert out[2, 0].inserted == "user" and out[3, 0].at_end == "assistant"
    assert chat.repaired(df).where("conv_id is null").count() == 2
    assert chat.repaired(df.where("false")).count() == 0
