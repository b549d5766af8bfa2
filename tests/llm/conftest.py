import random
from pathlib import Path

import pytest

SF_DIR = Path("/root/testdata/sf0.001")
# Columns that the operators use for themselves, beside those of documents.
EXTRA = ("score", "print", "queue", "core", "toxicity", "spans", "kept", "id", "kept_print")


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("no generated tables")
    return str(SF_DIR)


def sentence(rng, words):
    letters = "abcdefghijklmnop"
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(words))


@pytest.fixture(scope="session")
def hard_texts():
    """Null, empty, blank, long, repeated and ordinary texts, with and without ids."""
    rng = random.Random(1)
    plain = [sentence(rng, 60) for _ in range(12)]
    long = sentence(rng, 60_000)
    rows = [(i, text) for i, text in enumerate(plain)]
    rows += [(20, None), (21, ""), (22, " \n\t "), (23, long), (24, "x"), (25, plain[0])]
    rows += [(26, "é ß 漢字 \x1c <|endoftext|> \U0001f600 don't  stop\n\n"), (27, "a b " * 400)]
    rows += [(3, plain[3]), (None, "no id, " + plain[1]), (None, None), (5, "another text of five")]
    return rows


@pytest.fixture(scope="session")
def hard_documents(spark, hard_texts):
    """The same as a frame, with extra columns and nulls in them."""
    rows = [
        (i, text, None if k % 3 else "en", None if k % 4 == 0 else f"src{k % 3}", k, *["x"] * len(EXTRA))
        for k, (i, text) in enumerate(hard_texts)
    ]
    names = ", ".join(f"{name} string" for name in EXTRA)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {names}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(hard_documents):
    return hard_documents.where("false")


def found(frame, *columns):
    """Rows as sorted tuples; nulls first."""
    rows = (tuple(row) for row in frame.select(*columns).collect())
    return sorted(rows, key=lambda row: [(x is not None, x) for x in row])
