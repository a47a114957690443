import random

import numpy as np
import pytest

from spokewise.llm import token_counts as K

SETS = [
    [b" ", b" a", b"a", b"ab", b"abc", b" ab", b"b", b"cde", b" abcd"],
    [b" abc", b"abcx", b"bcd", b" a", b"b", b"c", b" "],
    [b" ab", b"abcabd", b"abc", b"a", b"b", b"c", b"d"],
    [b"a", b"b"],
    [],
]


def greedy(word, pieces):
    text, at, count = b" " + word, 0, 0
    while at < len(text):
        size = next((k for k in range(len(text) - at, 0, -1) if text[at : at + k] in pieces), 0)
        if size == 0:
            return 0
        at, count = at + size, count + 1
    return count


@pytest.mark.parametrize("pieces", SETS)
def test_lengths_equal_longest_match(pieces):
    rng = random.Random(4)
    words = [bytes(rng.choices(b"abcde", k=rng.randrange(1, 12))) for _ in range(800)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array([len(w) for w in words])
    found = K.Automaton.of(pieces).lengths(data, starts, ends)
    assert found.tolist() == [greedy(w, set(pieces)) for w in words]


def test_public_vocabulary_over_documents(documents):
    pieces = K.read_pieces()
    texts = ["The house stands.", None, "", " \n", "naïve café 東京", "x" * 3000, "word " * 30_000, "The house stands."]
    docs = documents(texts).withColumnRenamed("lang", "n_tokens")
    rows = {r.doc_id: r for r in K.count_tokens(docs, pieces, ["doc_id"]).collect()}
    known = set(pieces)
    for k, text in enumerate(texts):
        words = (text or "").split()
        assert rows[k].n_words == len(words)
        if len(words) < 100:
            assert rows[k].n_tokens == sum(greedy(w.encode(), known) for w in words)
        assert rows[k].n_unknown == 0
    assert K.count_tokens(docs.limit(0), pieces, ["doc_id"]).count() == 0


def test_unknown_words_count_their_bytes_and_memory_is_bounded(documents, monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED", 3)
    rows = K.count_tokens(documents(["ab zz ab", "zz ba", "aab bba abab"]), [b" ", b"a", b"ab", b"b"], ["doc_id"]).collect()
    found = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in rows}
    assert found[0] == (3, 2 + 2 + 2, 1) and found[1] == (2, 2 + 3, 1)
    with pytest.raises(ValueError):
        monkeypatch.setattr(K, "MOST_PIECES", 2)
        K.Automaton.of([b"a", b"b", b"c"])
