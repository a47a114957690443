import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) pairs."""

    def build(rows, source="s"):
        rows = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in rows], DOCS)

    return build


@pytest.fixture
def prose():
    """Invented sentences, the same for the same seed."""

    def words(seed, count):
        rng = random.Random(seed)
        return [rng.choice("abcdefghij") + rng.choice("klmno") + str(rng.randrange(300)) for _ in range(count)]

    return words
