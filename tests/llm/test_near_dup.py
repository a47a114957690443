import math
import random

import numpy as np
import pytest

from spokewise.llm import near_dup as N


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = low.translate({k: " " for k in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def by_hand(rows):
    """Component of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    top = {i: i for i, _ in rows if i is not None}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if rows[a][0] is None or rows[b][0] is None or not x or not y:
                continue
            if 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                top[q] = p
    return {i: find(i) for i in top}, sets


def check(docs, rows):
    wanted, sets = by_hand(rows)
    found = N.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == wanted
    assert sorted((r.doc_id or -1, r.n_shingles) for r in found) == sorted((i or -1, len(s)) for (i, _), s in zip(rows, sets))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def edited(words, count, seed):
    rng = random.Random(seed)
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_families_equal_brute_force(documents, prose):
    rows, n = [], 0
    for family in range(12):
        words = prose(family, 60 + 25 * family)
        for k in range(6):
            rows.append((n, edited(words, k * (1 + family // 4), n)))
            n += 1
    passage = " ".join(prose(999, 30))
    rows += [(n + k, passage + " " + " ".join(prose(2000 + k, 50))) for k in range(40)]
    check(documents(rows), rows)


def test_large_family_and_frequent_passage_split_nodes(documents, prose, monkeypatch):
    monkeypatch.setattr(N, "SMALL_NODE", 8)
    words = prose(5, 200)
    rows = [(k, edited(words, 1 + k % 9, k)) for k in range(60)]
    passage = " ".join(prose(7, 60))
    rows += [(100 + k, passage + " " + " ".join(prose(300 + k, 20))) for k in range(60)]
    check(documents(rows), rows)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "two one"), (7, "a b c d e"), (8, "a b c d e f"),
            (9, "x y z u v w"), (9, "x y z u v w"), (None, "one two")]
    found = {r.doc_id: r for r in N.near_duplicates(documents(rows)).collect()}
    assert found[5].component_id == 4 and not found[5].kept and found[4].kept
    assert found[6].component_id == 6 and found[8].component_id == 8
    assert [found[k].n_shingles for k in (1, 2, 3, 4, 7, 8)] == [0, 0, 0, 1, 1, 2]
    assert all(found[k].component_id == k for k in (1, 2, 3))
    assert found[9].kept and found[None].component_id is None and found[None].kept


def test_empty_table_and_columns_pass_through(documents):
    docs = documents([(1, "one two three four five six"), (2, "one two three four five six")]).withColumnRenamed("lang", "component_id")
    rows = N.drop_near_copies(docs)
    assert rows.columns == docs.columns and [r.doc_id for r in rows.collect()] == [1]
    assert N.near_duplicates(docs.limit(0)).count() == 0


def chance_to_miss(similarity):
    """Chance that a pair parts in every tree, or is left out before."""
    together = 1.0
    for _ in range(N.DEPTH):
        together = 1 - (1 - similarity * together) ** N.PICKS
    few = sum(math.comb(N.PROBES, k) * similarity**k * (1 - similarity) ** (N.PROBES - k) for k in range(N.LEAST_SHARED))
    return (1 - together) ** N.TREES + few


def test_pairs_at_the_threshold_are_hardly_ever_missed():
    assert chance_to_miss(0.75) < 0.00015


@pytest.mark.parametrize("seed", [148, 4323])
def test_pairs_that_few_tokens_bring_together(documents, prose, seed):
    words = prose(seed, 20)
    rows = [(1, " ".join(words[:18])), (2, " ".join(words[:16] + words[18:]))]
    check(documents(rows), rows)


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    found = {r.id: r.comp for r in N.connected(links).collect()}
    assert found == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (3000, 500, 500))
    x, y = (N.signature(np.unique(np.concatenate([common, c]))) for c in (a, b))
    assert abs((x == y).mean() - 0.75) < 0.15


@pytest.mark.parametrize("width", [2, 5])
def test_shingle_hashes_stand_for_word_runs(width):
    import pyarrow as pa

    from spokewise.llm.batches import slices

    texts = ["a b c d e f g", "c d e f g", "A B c d", "", "b a"]
    pieces = list(slices(pa.array([t.encode() for t in texts], pa.binary())))
    sets = [set(s.tolist()) for p in pieces for s in N.shingle_sets(p, width)]
    assert sets[1] <= sets[0] and not sets[3]
    assert len(sets[0]) == 7 - width + 1


def test_sets_too_large_to_carry_are_confirmed_all_the_same(documents, prose, monkeypatch):
    rows = []
    for family in range(2):
        words = prose(120, 60 + family)
        rows += [(100 * family + k, " ".join(edited(words, k % 9, 7 * k + family))) for k in range(20)]
    monkeypatch.setattr(N, "CARRIED", 0)
    check(documents(rows), rows)


def test_alike_is_exact_at_the_threshold():
    whole = np.arange(8, dtype=np.uint64)
    assert N.alike(whole, whole[:6], 75)
    assert not N.alike(whole, whole[:5], 75)
    assert N.alike(whole[:7], whole[1:], 75)
    assert not N.alike(whole[:6], whole[1:7], 75)
