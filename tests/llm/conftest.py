import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(6000))
BASE = " ".join(f"t{i}" for i in range(120))
TEXTS = [
    (1, BASE, "a"),
    (2, BASE.replace("t60 ", "x60 "), "a"),  # near copy
    (3, BASE.replace("t10 ", "x10 ").replace("t100 ", "x100 "), "b"),
    (4, BASE.replace(" ", "\n"), None),  # equal to 1 after white space
    (5, None, "a"),
    (6, "", "b"),
    (7, " \t\n", None),
    (8, "one two", "a"),
    (9, "One  two", "b"),
    (10, LONG, "c"),
    (11, LONG, "c"),
    (12, "alone here with six other words", "c"),
    (12, "alone here with six other words", "c"),  # a repeated row
    (None, "no id at all but some words", "a"),
    (None, BASE, "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents, with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "en" if i is None or i % 2 else None, s, len(t or ""), i or 0, "x", True, 1.5, "q", 3) for i, t, s in TEXTS]
    shape = "doc_id long, text string, lang string, source string, n_chars long, n long, digest string, kept boolean, score double, _key string, rows int"
    return spark.createDataFrame(rows, shape).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
