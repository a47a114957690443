import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spokewise.llm import token_files as K

PATH = public_tokenizers.path("word_bpe_49k.json")
SEPARATOR = "<|endoftext|>"
DIRECT = Tokenizer.from_file(PATH)


def ids_of(text):
    return DIRECT.encode(text or "", add_special_tokens=False).ids + [K.END_ID]


ODD = [
    (5, "The house stands."), (None, "no id"), (None, None), (7, None), (8, ""), (9, " \n\t"), (3, "naïve café 東京 ﬁ é"), (-4, "x" * 3000),
    (11, "word " * 30_000), (5, "The house stands."), (5, "another of that id"), (12, "a <|endoftext|> b<|startoftext|>c <|endof text|>"),
    (2**60, "don't STOP it's \x1c \x85 　 odd space"), (13, "\x0b\x0c\r"),
]


def by_hand(rows):
    """Of rows with one id the order is that of the texts' hashes, so only their set is known."""
    out, start = {}, 0
    for i in sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0)):
        own = [ids_of(t) for k, t in rows if k == i]
        out[i] = (start, sorted((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in own))
        start += sum(map(len, own))
    return out


def compare(found, rows):
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    wanted = by_hand(rows)
    assert got.keys() == wanted.keys()
    for i, own in got.items():
        own.sort()
        assert own[0][0] == wanted[i][0]
        assert [a[0] + a[1] for a in own[:-1]] == [b[0] for b in own[1:]]
        assert sorted(a[1:] for a in own) == wanted[i][1]


@pytest.mark.parametrize("file_ids, tasks, keys", [(K.FILE_IDS, 3, 1 << 17), (5, 6, 2)])
def test_files_hold_what_the_tokenizer_gives(spark, documents, file_ids, tasks, keys):
    docs = documents(ODD).withColumns({n: F.lit("x") for n in ("key", "copy", "file", "part", "name")})
    found = K.round_trip(docs, PATH, SEPARATOR, file_ids=file_ids, tasks=tasks, keys_per_bucket=keys)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    compare(found.collect(), ODD)


def test_one_id_with_a_third_of_all_rows_and_many_tasks(documents):
    rows = [(7 if k % 3 else k, f"text {k % 40}") for k in range(300)] + [(None, f"t{k}") for k in range(40)]
    compare(K.round_trip(documents(rows), PATH, SEPARATOR, file_ids=64, tasks=9, keys_per_bucket=50).collect(), rows)


def test_keyed_access_finds_ids_and_turns_strangers_away(spark, documents):
    rows = [(k * 3, f"document number {k}") for k in range(500)]
    data = K.write(documents(rows), PATH, SEPARATOR, tasks=4, file_ids=200, keys_per_bucket=64)
    keys = spark.createDataFrame([(k, 0) for k in range(0, 1600, 2)] + [(3, 1), (6, 0), (None, 0)], "key long, copy long")
    found = K.read(data, K.lookup(data, keys), with_ids=True).collect()
    texts = dict(rows)
    assert sorted(r.key for r in found) == sorted([6, *[k for k in range(0, 1600, 2) if k in texts]])
    assert all(r.ids == ids_of(texts[r.key]) for r in found)


def test_text_keys_and_whole_text_encoding(spark):
    docs = spark.createDataFrame([("b", "Two words"), ("a", "one"), ("ä", None)], "name string, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = {r.name: r for r in K.round_trip(docs, path, None, "name").collect()}
    direct = Tokenizer.from_file(path)
    assert [found[k].n_tokens for k in ("a", "b", "ä")] == [2, len(direct.encode("Two words").ids) + 1, 1]
    assert [found[k].start for k in ("a", "b")] == [0, 2]


def test_empty_table(documents):
    assert K.round_trip(documents([]), PATH, SEPARATOR).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 100, 20_000])
def test_perfect_hash_numbers_each_key_once(count):
    rng = np.random.default_rng(count)
    h1, h2 = rng.integers(0, 1 << 63, (2, count)).astype(np.uint64)
    index = K.Index.of(h1, h2, {n: np.arange(count) for n in K.VALUES})
    again = K.Index.from_bytes(index.to_bytes())
    at = again.find(h1, h2)
    assert sorted(at.tolist()) == list(range(count))
    assert (again.values["start"][at] == np.arange(count)).all() if count else True
    s1, s2 = rng.integers(0, 1 << 63, (2, 1000)).astype(np.uint64)
    assert (again.find(s1, s2) == -1).all()


def test_equal_hashes_are_refused():
    same = np.array([5, 5], np.uint64)
    with pytest.raises(ValueError):
        K.PerfectHash.of(same, same)


_encoder = K.Encoder(PATH, SEPARATOR)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'<|>ad́가Σς"))), max_size=5))
def test_words_apart_give_the_ids_of_the_whole_text(texts):
    found = [np.frombuffer(b, "<u2").tolist() for b in _encoder.ids([t.encode() for t in texts])]
    assert found == [DIRECT.encode(t, add_special_tokens=False).ids for t in texts]
