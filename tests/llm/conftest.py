import random

import pytest

from granary.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents table from {doc_id: text} or a list of pairs."""
    ship(spark)

    def build(texts):
        pairs = texts.items() if isinstance(texts, dict) else texts
        return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in pairs], SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of words of a skewed vocabulary, the same in every run."""

    def build(n, seed, words=120):
        draw = random.Random(seed)
        vocabulary = ["".join(draw.choices("abcdefghiklmnoprstu", k=draw.randint(2, 8))) for _ in range(800)]
        weights = [1 / (k + 1) for k in range(800)]
        return [" ".join(draw.choices(vocabulary, weights, k=words)) + "." for _ in range(n)]

    return build


#: Null, empty, blank, one word, not ASCII, very long, and two equal rows.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Éé ß 中文 😀 x"), (6, "long words here " * 20000), (7, "same row"), (7, "same row")]


@pytest.fixture
def odd():
    return list(ODD)
