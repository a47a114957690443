"""A Merkle manifest of a table, and what tampering with single rows does to its root.

A row's leaf is the hash of its fields. Inside each group (here: a source) leaves stand
in id order; three neighbours at a time become the hash of their digests, level by level,
until one node is left. The groups' roots form a tree of the same kind, whose root stands
for the whole table.

Leaves are numbered by a range sort, so a group of any size is dealt over many tasks.
Aligned blocks of ``3**BLOCK_LEVELS`` nodes make complete subtrees: each is built in one
task from at most that many digests. Block roots are the leaves of the next round, until
one node a group is left; the groups' roots go through the same rounds. A tampered leaf
makes a version of its block: a persistent tree that shares all untouched nodes and
copies only the ancestors of the leaf. The version goes on above its block along the
block's own path, which is found once a block and sent down to it, so that no upper node
ever gathers the versions below.

Results for odd input: NULL fields are hashed as ``-``, an empty text as ``0:``; NULL is
a group of its own, before all others; a row without an id comes last in its group and is
never tampered with; rows with the same id stand in the order of their leaves, and equal
rows in any; a group of one row has the leaf as its root, and a table of one group that
group's root, with an empty proof; an empty table gives an empty result; further columns
do no harm. Whole texts are read, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from spokewise.llm.batches import by_place, place_of
from spokewise.operators.positions import row_index
from spokewise.session import stage

ARITY = 3
# A task builds subtrees of at most ARITY**BLOCK_LEVELS leaves.
BLOCK_LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# The digests left and right of a node in its run.
Sides = tuple[str, str]


def node_hash(digests: str) -> str:
    return hashlib.sha256(digests.encode()).hexdigest()


def depth(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


@dataclass(frozen=True)
class Version:
    """A tree with one leaf changed: the nodes copied for it, leaf first; all others are shared."""

    base: Tree
    at: int
    copied: tuple[str, ...]

    @property
    def root(self) -> str:
        return self.copied[-1]

    def node(self, level: int, place: int) -> str:
        return self.copied[level] if place == self.at // ARITY**level else self.base.levels[level][place]


@dataclass(frozen=True)
class Tree:
    levels: tuple[tuple[str, ...], ...]  # leaves first

    @staticmethod
    def of(leaves: Sequence[str], height: int) -> Tree:
        levels = [tuple(leaves)]
        for _ in range(height):
            below = levels[-1]
            levels.append(tuple(node_hash("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)))
        return Tree(tuple(levels))

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def sides(self, at: int) -> list[Sides]:
        """What stands beside the path from leaf ``at`` to the root, level by level."""
        out = []
        for level in self.levels[:-1]:
            first = at - at % ARITY
            out.append(("".join(level[first:at]), "".join(level[at + 1 : first + ARITY])))
            at //= ARITY
        return out

    def version(self, at: int, leaf: str) -> Version:
        return Version(self, at, tuple(climb(leaf, self.sides(at))))


def climb(digest: str, sides: Sequence[Sides]) -> list[str]:
    """The digest and its ancestors along a path."""
    out = [digest]
    for left, right in sides:
        out.append(node_hash(left + out[-1] + right))
    return out


def field_text(column: Column) -> Column:
    """A field as it is hashed: ``-`` for NULL, else its length in UTF-8, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in fields]), 256)


def leaves(docs: DataFrame, fields: Sequence[str], tampered: dict[str, Callable[[Column], Column]], where: Callable[[Column], Column]) -> DataFrame:
    """One row per document: id, source, leaf, and ``altered``, the leaf after tampering where that changes it.

    ``tampered`` maps fields to what tampering makes of them, in rows whose id satisfies
    ``where``. The first two fields are the id and the group.
    """
    plain = by_place(docs)
    column = {n: F.col(place_of(docs, n)) for n in fields}
    changed = {n: change(column[n]) for n, change in tampered.items()}
    differs = F.lit(False)
    for n, new in changed.items():
        differs = differs | ~column[n].eqNullSafe(new)
    chosen = F.coalesce(where(column[fields[0]]), F.lit(False)) & differs
    after = F.when(chosen, leaf_hash([changed.get(n, column[n]) for n in fields]))
    return plain.select(
        column[fields[0]].alias("id"), column[fields[1]].alias("group"), leaf_hash(list(column.values())).alias("leaf"), after.alias("altered")
    )


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """From (tree, place, digest, nodes) to the same of the block roots."""
    size = ARITY**levels

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        count = int(group["nodes"].iloc[0])
        tree = Tree.of(group["digest"].tolist(), min(levels, depth(count)))
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "digest": [tree.root], "nodes": [-(-count // size)]})

    blocks = nodes.select("tree", F.floor(F.col("place") / size).cast("long").alias("block"), "place", "digest", "nodes")
    return blocks.groupBy("tree", "block").applyInPandas(build, "tree long, place long, digest string, nodes long")


_PATH = "array<struct<l: string, r: string>>"


def _joined(path: Sequence[Sides], above: pd.DataFrame) -> list[Sides]:
    upper = above["path"].iloc[0] if len(above) else []
    return [*path, *[(s["l"], s["r"]) for s in upper]]


def paths(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """From (tree, place, digest, nodes): every node's path (tree, place, path), and the trees' roots (tree, digest).

    One round per ``levels`` levels; a round hands on one row per block.
    """
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    if most <= 1:
        return nodes.select("tree", "place", F.array().cast(_PATH).alias("path")), nodes.select("tree", "digest")
    size = ARITY**levels
    blocks = stage(_block_roots(nodes, levels), "blocks")
    above, roots = paths(blocks, levels)

    def descend(key: tuple, group: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        tree = Tree.of(group["digest"].tolist(), min(levels, depth(int(group["nodes"].iloc[0]))))
        found = [[{"l": a, "r": b} for a, b in _joined(tree.sides(k), up)] for k in range(len(group))]
        return pd.DataFrame({"tree": group["tree"], "place": group["place"], "path": found})

    below = nodes.withColumn("block", F.floor(F.col("place") / size).cast("long")).groupBy("tree", "block")
    above = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    return stage(below.cogroup(above).applyInPandas(descend, f"tree long, place long, path {_PATH}"), "paths"), roots


_FOUND = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(found: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Roots, proofs and recomputed roots of all rows of ``leaves``.

    The group's name plays no part beyond its order.
    """
    size = ARITY**levels
    id_type = found.schema["id"].dataType
    # The tag spreads equal rows over the range sort; it is fixed by being written.
    rows = stage(found.withColumn("tag", F.monotonically_increasing_id()), "leaves")
    # By name with NULL first; by id with NULL last.
    rows = rows.withColumn("named", F.col("group").isNotNull().cast("int"))
    placed = row_index(rows, ["named", "group", "id", "leaf", "tag"], "at")
    groups = placed.groupBy("named", "group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("nodes"))
    groups = stage(row_index(groups, ["named", "group"], "tree"), "groups").withColumn("tree", F.col("tree") - 1)
    same = placed["group"].eqNullSafe(groups["group"])
    placed = placed.join(groups.select("group", "tree", "first", "nodes"), same).select(
        "tree", (F.col("at") - F.col("first")).alias("place"), "id", F.col("leaf").alias("digest"), "altered", "nodes"
    )
    placed = stage(placed, "numbered")
    blocks = stage(_block_roots(placed.drop("id", "altered"), levels), "blocks")
    above, subroots = paths(blocks, levels)
    subroots = stage(subroots, "subroots")
    count = subroots.count()
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(count).cast("long").alias("nodes"))
    across, root = paths(tops, levels)
    across = across.select(F.col("place").alias("tree"), F.col("path").alias("across"))
    above = above.join(across, "tree").join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    top = root.first()
    root = top["digest"] if top else None
    above = above.select("tree", F.col("place").alias("block"), F.concat("path", "across").alias("path"), "subroot")

    def judge(key: tuple, group: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        tree = Tree.of(group["digest"].tolist(), min(levels, depth(int(group["nodes"].iloc[0]))))
        upper = _joined([], up)
        whole = climb(tree.root, upper)[-1]
        proofs, folded = [], []
        for k, altered in enumerate(group["altered"]):
            proofs.append(node_hash("".join(a + b for a, b in [*tree.sides(k), *upper])))
            folded.append(climb(tree.version(k, altered).root, upper)[-1] if isinstance(altered, str) else whole)
        same = [f == root for f in folded]
        return pd.DataFrame(
            {
                "id": group["id"], "leaf": group["digest"], "subroot": up["subroot"].iloc[0], "root": root,
                "proof_sha256": proofs, "folded_root": folded, "verified": same,
            }
        )

    below = placed.withColumn("block", F.floor(F.col("place") / size).cast("long")).withColumn("id", F.col("id").cast("string"))
    judged = below.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(judge, _FOUND)
    return judged.withColumn("id", F.col("id").cast(id_type))


def tampered_manifest(docs: DataFrame, id_column: str = "doc_id", levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of documents of which those with an even CRC-32 of their id lose their line feeds."""
    fields = [id_column if n == "doc_id" else n for n in FIELDS]
    even = lambda i: F.crc32(i.cast("string").cast("binary")) % 2 == 0
    found = leaves(docs, fields, {"text": lambda t: F.replace(t, F.lit("\n"), F.lit(""))}, even)
    return prove(found, levels).withColumnRenamed("id", id_column)
