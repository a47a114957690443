import hashlib
import random
import zlib

import pytest

from spokewise.llm import merkle as M

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    i, text, lang, source, n = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb_all(nodes):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 3 * 3
        out.append((level[run:at], level[at + 1 : run + 3]))
        at //= 3
    return out


def by_hand(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is None, r[0] or 0, leaf_of(r))) for s in sources}
    trees = {s: climb_all([leaf_of(r) for r in own[s]]) for s in sources}
    top = climb_all([trees[s][-1][0] for s in sources])
    root, out = top[-1][0] if top[-1] else None, []
    for k, s in enumerate(sources):
        for at, row in enumerate(own[s]):
            sides = path(trees[s], at) + path(top, k)
            i, text, lang, source, n = row
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 2 == 0:
                row = (i, text.replace("\n", ""), lang, source, n)
            digest = leaf_of(row)
            for left, right in sides:
                digest = h("".join(left) + digest + "".join(right))
            proof = h("".join("".join(left + right) for left, right in sides))
            out.append((i, trees[s][0][at], trees[s][-1][0], root, proof, digest, digest == root))
    return out


def found(spark, rows, levels):
    return [tuple(r) for r in M.tampered_manifest(spark.createDataFrame(rows, DOCS), levels=levels).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple(str(v) for v in r))


ODD = [
    (1, "a\nb", "en", "s", 3), (2, "\n", None, "s", 1), (2, "\n", None, "s", 1), (2, "other", "en", "s", None), (3, None, "en", "s", 0),
    (None, "no\nid", "en", "s", 5), (None, None, None, None, None), (4, "", "en", None, 0), (5, "é\n東", "fr", "é", 3), (6, "x", "en", "z", 1),
    (7, "y\n" * 100_000, "en", "z", 1), (-8, "minus\n", "en", "z", 1), (2**62, "large\n", "en", "", 1),
]


@pytest.mark.parametrize("levels", [1, 7])
def test_odd_rows_match_folding_by_hand(spark, levels):
    assert order(found(spark, ODD, levels)) == order(by_hand(ODD))


def test_hot_source_and_many_sources_over_several_rounds(spark):
    rng = random.Random(5)
    rows = [(k, f"line {k}\n" * rng.randrange(3), "en", "hot" if k % 3 else f"s{rng.randrange(40)}", k) for k in range(400)]
    got = found(spark, rows, 2)
    assert order(got) == order(by_hand(rows))
    assert len({r[3] for r in got}) == 1
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10])
def test_sizes_around_whole_runs(spark, count):
    rows = [(k, f"{k}\n", "en", "s", 1) for k in range(count)]
    assert order(found(spark, rows, 1)) == order(by_hand(rows))


def test_versions_share_untouched_nodes():
    tree = M.Tree.of([h(str(k)) for k in range(20)], M.depth(20))
    version = tree.version(13, h("new"))
    again = climb_all([h("new") if k == 13 else h(str(k)) for k in range(20)])
    assert version.root == again[-1][0] != tree.root
    assert [[version.node(level, p) for p in range(len(nodes))] for level, nodes in enumerate(again)] == again
    assert len(version.copied) == len(tree.levels) and version.node(0, 3) is tree.levels[0][3]


def test_empty_table_and_further_columns(spark):
    assert M.tampered_manifest(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame(ODD[:3], DOCS).selectExpr("*", "'x' AS leaf", "1 AS `group`", "2 AS tree", "3 AS tag", "4 AS at")
    got = [tuple(r) for r in M.tampered_manifest(docs).collect()]
    assert order(got) == order(by_hand(ODD[:3]))
