import pytest

LONG = "longword " * 30_000
PASSAGE = " ".join(f"shared{k}" for k in range(60))


def near(k, n=200, changed=()):
    """A text of its own words, some of them changed."""
    return " ".join(f"w{k}x{j}" if j not in changed else f"c{k}x{j}" for j in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, copies, and columns whose names operators use inside."""
    base = near(1)
    rows = [
        (1, base), (2, base), (3, near(1, changed=(5, 120))), (4, near(1, changed=(5, 60, 120))), (5, near(2)), (6, PASSAGE + " " + near(3, 30)), (7, PASSAGE + " " + near(4, 30)),
        (8, PASSAGE + " " + near(5, 30)), (9, None), (10, ""), (11, " \n\t "), (12, LONG), (13, "two words"), (14, "Two  WORDS"), (15, None), (5, near(2)), (None, base), (16, "ümläut ß 😀 é it's <|endoftext|>"),
    ]
    data = [(i, t, "en", "s" if i and i % 3 else None, None if t is None else len(t), "mine", 7, 3) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, ledger string, shard int, slot int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
