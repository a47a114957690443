import re
from itertools import permutations

import numpy as np
import pytest

from spokewise.llm import filter_audit as A

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"

LONG = " ".join(f"w{k}" for k in range(200))
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG + " $", "b"), (4, "same " * 250, None), (5, None, "a"), (6, "", "b"),
    (6, "", "b"), (None, LONG, "b"), (None, None, None), (7, "SHOUT ALL", ""), (8, "é" * 97 + "ABC", "b"),
    (9, "\x1ca\x0bb c", "a"), (9, LONG.upper() + " #", "c"), (10, LONG.upper() + " #", "c"), (11, "word " * 200_000, "c"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (3, None, 1), (6, 1, None), (6, 0, 0), (7, 0, 1), (None, 1, 1), (10, 1, 1), (99, 1, 1)]


def by_hand(rows, marks):
    firsts = {}
    for i, text, _ in rows:
        if i is not None:
            firsts[text or ""] = min(firsts.get(text or "", i), i)
    judged = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > firsts[text],
        }
        good = i is not None and any(m == i and q == 1 for m, q, _ in marks)
        toxic = i is not None and any(m == i and t == 1 for m, _, t in marks)
        judged.append((part or "", {f for f, v in fails.items() if v}, good, toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                goes = [j for j in left if f in j[1]]
                earlier = [j for j in own if f in j[1] and j not in goes and j[1] & set(order[:k])]
                left = [j for j in left if f not in j[1]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(goes), len(earlier), sum(j[1] == {f} for j in own), sum(j[2] for j in goes), sum(j[3] for j in goes)
                ]
    shapley = {}
    for (part, order, k), values in out.items():
        shapley[part, order[k - 1]] = shapley.get((part, order[k - 1]), 0) + values[1]
    return {key: tuple([*values, shapley[key[0], key[1][key[2] - 1]]]) for key, values in out.items()}


def found(spark, rows, marks):
    docs = spark.createDataFrame([(i, t, "en", p, 0) for i, t, p in rows], DOCS)
    table = A.audit_documents(docs, spark.createDataFrame(marks, LABELS)).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in table}, len(table)


def test_all_orders_match_filtering_by_hand(spark):
    table, rows = found(spark, ROWS, MARKS)
    assert table == by_hand(ROWS, MARKS)
    assert rows == len(table) == 4 * 600


def test_one_large_group_of_copies_and_one_large_source(spark):
    rows = [(k, "copy of one text", "hot") for k in range(900)] + [(1000 + k, f"text {k} #", f"s{k % 3}") for k in range(30)]
    table, _ = found(spark, rows, [(k, 1, 0) for k in range(0, 900, 2)])
    assert table["hot", "EABCD", 1] == (1, 899, 0, 0, 449, 0, 899 * 60)
    assert table["hot", "ABCDE", 5] == (0, 0, 899, 0, 0, 0, 899 * 60)
    assert table["s0", "DABCE", 1][:3] == (0, 10, 0)


def test_contractions_equal_loops():
    rng = np.random.default_rng(3)
    tensors = rng.integers(0, 9, (3, 2, 2, 2))
    steps = A.Steps.of("xyz")
    got = A.contract(tensors, steps.kept)
    for p in range(3):
        for s, vectors in enumerate(steps.kept):
            want = sum(
                tensors[p][i, j, k] * vectors[0][i] * vectors[1][j] * vectors[2][k]
                for i in range(2) for j in range(2) for k in range(2)
            )
            assert got[p, s] == want
    assert len(steps.orders) == 18


@pytest.mark.parametrize("columns", [["mask", "digest", "copies", "part", "id"]])
def test_empty_tables_and_clashing_names(spark, columns):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert A.audit_documents(docs, labels).count() == 0
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    plain = sorted(map(tuple, A.audit_documents(docs, labels).collect()))
    for name in columns:
        docs, labels = docs.selectExpr("*", f"'x' AS {name}"), labels.selectExpr("*", f"'x' AS {name}")
    assert sorted(map(tuple, A.audit_documents(docs, labels).collect())) == plain
