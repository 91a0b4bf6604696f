import os
import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "label string, score double, node long, piece int, length long, ids binary, host string, run int, row long"
)


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(5)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma,", "délta", "epsilon.\n"]) + str(i % 977) for i in range(40_000))
    return [
        (0, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (3, "x"), (4, "One two  three\tfour"), (5, "one two three four"),
        (6, "One two three four five six seven eight nine ten"), (7, "One two three four five six seven eight nine ten"),
        (8, "é漢字😀 ñandú"), (9, "z" * 5000), (10, long_text), (11, long_text + " end"), (12, "<|endoftext|> a<|endoftext|>"),
        (13, "12 345 !!! ???"), (14, "Onetwothreefour"), (9, "z" * 5000), (None, "no id here"), (20, "a\u00a0b \u3000 c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """Texts of every awkward kind, repeated rows, NULLs, and columns named like inner ones."""
    rows = [(i, t, "en" if i else None, None, 1, "l", 0.5, 1, 1, 1, b"x", "h", 1, 1) for i, t in odd_texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    found = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(found):
        pytest.skip("driver tables not present")
    return found
