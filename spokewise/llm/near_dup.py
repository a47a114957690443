"""Near duplicates by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents with equal sets form one
class at once, so copies cost nothing further. A class that is alone with most of its
first minwise tokens can have no partner and is left out. The other classes'
representatives are branched recursively: a node of a tree picks minwise tokens of its sets, and each pick
sends every set to the child of the token it has there. Two sets of similarity s stay
together with chance s per pick; with two picks per node a pair at the threshold gets to
the end of a tree with chance 0.89, so that four independent trees miss it with chance 0.00015.
Nodes that are small enough are compared exhaustively; larger ones branch further. Nodes
whose sets are linked already need no comparison, so a large family of near copies,
chained together in the first round, costs no work that grows with its square.

Comparison inside a node estimates similarity from signatures to find candidates; every
link is confirmed on the full sets. Before large nodes branch, the shingles of all sets that
may still have a partner outside their component are counted: shingles that a set shares with no other bound its
similarity to any of them, which rules out most of a family of edited copies without
looking at a pair. Only what is left branches and is compared, a node whose children would
hold no fewer pairs as it is. Candidates get a second look by longer signatures. Components are found by star contraction.

Results for odd input: NULL text, text without words and empty text have an empty set
and link with nothing; a text of fewer words than a shingle is one shingle; rows that
share an id count as one document with several texts; a row with a NULL id is compared
with nothing, has a NULL component and is kept; an empty table gives an empty result;
further columns do no harm.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spokewise.llm.batches import (
    SPACED_WORDS,
    TextSlice,
    batch_of,
    by_place,
    find_words,
    lower_ascii,
    map_batches,
    mix,
    place_of,
    slices,
    word_hashes,
)
from spokewise.session import stage

SHINGLE = 5
THRESHOLD = 0.75
TREES = 4
PICKS = 2
DEPTH = 6
# Sets a node may have to be compared exhaustively in one task.
SMALL_NODE = 256
HASHES = 128
# Candidates: estimated similarity at least this. Four standard deviations of the estimate below the threshold.
SLACK = 0.15
# Second look at candidates, by longer signatures: five standard deviations below the threshold.
FINE = 1024
FINE_SLACK = 0.07
# Sets of at most so many shingles travel with their signatures and are intersected on the spot.
CARRIED = 4096

# A class is left out if it shares fewer of its first PROBES minwise tokens with any other.
# A partner at the threshold shares so few with chance 4e-10, a more alike one with less.
PROBES = 32
LEAST_SHARED = 8
# The same by all tokens, for sets that share a node with another component: chance 3.4e-10.
LEAST_SHARED_OF_ALL = 64



def _functions(count: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of so many hash functions."""
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(salt)) >> np.uint64(32)
    return seeds[:count].astype(np.uint32) | np.uint32(1), seeds[count:].astype(np.uint32)


_COARSE = _functions(HASHES, 0xA0761D6478BD642F)
_FINE = _functions(FINE, 0xE7037ED1A0B428DB)


def shingle_sets(piece: TextSlice, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a slice."""
    data = lower_ascii(piece.data)
    words = find_words(TextSlice(piece.first, piece.last, data, piece.starts), SPACED_WORDS)
    hashes = word_hashes(data, words)
    weights = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    rolled = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += hashes[k : k + len(rolled)] * weights[k]
    rolled = mix(rolled)
    for a, b in zip(words.row_ends[:-1], words.row_ends[1:]):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            whole = (hashes[a:b] * weights[: b - a]).sum(keepdims=True, dtype=np.uint64)
            yield mix(whole ^ np.uint64(0x5851F42D4C957F2D + int(b - a)))
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray] = _COARSE) -> np.ndarray:
    """The least value of each hash function over a set."""
    factors, shifts = functions
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(values), 1024):
        block = values[k : k + 1024, None] * factors + shifts
        np.minimum(low, block.min(axis=0), out=low)
    return low


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, full, short = [], [], [], []
            for piece in slices(batch.column(1)):
                for shingles in shingle_sets(piece, width):
                    sizes.append(len(shingles))
                    if len(shingles) == 0:
                        keys.append(None), full.append(None), short.append(None)
                        continue
                    # Two independent sums over the set name it.
                    second = mix(shingles ^ np.uint64(0x9FB21C651E98DF25))
                    names = np.array([shingles.sum(dtype=np.uint64), second.sum(dtype=np.uint64)])
                    keys.append(names.tobytes())
                    low = signature(shingles)
                    full.append(low.astype(np.int32))
                    short.append((low & 0xFF).astype(np.uint8).tobytes())
            yield batch_of(
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(full, pa.list_(pa.int32())),
                pa.array(short, pa.binary()),
            )

    return run


# ---- nodes of the trees


def _coordinates(depth: int) -> list[list[int]]:
    """Hash function picked at each branch: ``[level][path]``; no path picks one twice."""
    levels: list[list[int]] = []
    used: list[set[int]] = [set() for _ in range(TREES)]
    for level in range(depth):
        row, next_used = [], []
        for path in range(TREES * PICKS ** (level + 1)):
            above = used[path // PICKS]
            free = [c for c in range(HASHES) if c not in above]
            pick = random.Random(f"{level}/{path}").choice(free)
            row.append(pick)
            next_used.append(above | {pick})
        levels.append(row)
        used = next_used
    return levels


def _children(entries: DataFrame, level: int, picks: list[int]) -> DataFrame:
    """From (node, path, id, sig) to the entries (parent, node, path, id) one level down."""
    table = F.array(*[F.lit(p) for p in picks])
    branches = []
    for b in range(PICKS):
        path = F.col("path") * PICKS + b
        value = F.element_at("sig", F.element_at(table, path + 1) + 1)
        branches.append(F.struct(F.xxhash64("node", F.lit(level), path, value).alias("node"), path.alias("path")))
    born = entries.select(F.col("node").alias("parent"), "id", F.explode(F.array(*branches)).alias("e"))
    return born.select("parent", "e.node", "e.path", "id")


def _stuck(nodes: DataFrame, born: DataFrame) -> DataFrame:
    """The nodes whose children together hold no fewer pairs: branching does not part their sets."""
    counts = born.groupBy("parent", "node").agg(F.count(F.lit(1)).alias("part"))
    counts = counts.groupBy("parent").agg(F.sum(F.col("part") * F.col("part")).alias("pairs"))
    rows = nodes.join(counts, F.col("node") == F.col("parent")).filter(F.col("pairs") >= F.col("size") * F.col("size"))
    return rows.select(F.col("node").alias("n_node"), "size", "least", "most", "members")


def _nodes(entries: DataFrame, components: DataFrame | None) -> DataFrame:
    """Size of each node that has sets of more than one component left to compare."""
    stats = [
        F.count(F.lit(1)).alias("size"),
        F.min("comp").alias("least"),
        F.max("comp").alias("most"),
        F.bit_xor(F.xxhash64("id")).alias("members"),
    ]
    rows = with_component(entries, components)
    return rows.groupBy("node").agg(*stats).filter("least < most")


def with_component(rows: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return rows.withColumn("comp", F.col("id"))
    found = components.select(F.col("id").alias("c_id"), F.col("comp").alias("c_comp"))
    joined = rows.join(found, F.col("id") == F.col("c_id"), "left")
    return joined.withColumn("comp", F.coalesce("c_comp", "id")).drop("c_id", "c_comp")


def _unlike(nodes: DataFrame) -> DataFrame:
    """One of the nodes that have the very same members."""
    same = nodes.groupBy("members", "size", "least", "most").agg(F.min("node").alias("node"))
    return same.select("node", "size")


# ---- comparison inside nodes


def _packs(entries: DataFrame, short: DataFrame, sized: DataFrame, by_component: bool) -> DataFrame:
    """Members of each node with their signatures, in packs of bounded size.

    With ``by_component`` a component with many members in the node has packs of its own.
    """
    rows = entries.join(sized.select(F.col("node").alias("s_node"), "size"), F.col("node") == F.col("s_node")).drop("s_node")
    own = F.lit(None).cast("long")
    count = F.ceil(F.col("size") / SMALL_NODE)
    if by_component:
        parts = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("part"))
        parts = parts.filter(F.col("part") > SMALL_NODE // 2).select(F.col("node").alias("p_node"), F.col("comp").alias("p_comp"), "part")
        rows = rows.join(parts, (F.col("node") == F.col("p_node")) & (F.col("comp") == F.col("p_comp")), "left")
        own = F.when(F.col("part").isNotNull(), F.col("comp"))
        count = F.ceil(F.coalesce("part", "size") / SMALL_NODE)
    rows = rows.select("node", "id", "comp", own.alias("own"), F.pmod(F.xxhash64("node", "id"), count).alias("slice"))
    rows = rows.join(short.withColumnRenamed("id", "h_id"), F.col("id") == F.col("h_id"))
    members = F.collect_list(F.struct("id", "comp", "short", "n", "shared", "fine", "carried")).alias("members")
    return rows.groupBy("node", "own", "slice").agg(members)


def _unpack(column: pa.Array, k: int) -> list[np.ndarray]:
    """Ids, components, set sizes, shared shingles, signatures, long signatures and carried sets (None: not carried) of one pack."""
    rows = column[k].values
    short = np.frombuffer(b"".join(rows.field(2).to_pylist()), np.uint8).reshape(len(rows), HASHES)
    known = rows.field(5).is_valid().to_numpy(zero_copy_only=False)
    fine = np.frombuffer(b"".join(rows.field(5).drop_null().to_pylist()), np.uint8).reshape(-1, FINE)
    at = np.where(known, np.cumsum(known) - 1, -1)
    sets = np.empty(len(rows), object)
    for k, x in enumerate(rows.field(6)):
        sets[k] = np.frombuffer(x.as_buffer(), np.uint64) if x.is_valid else None
    return [rows.field(f).to_numpy(zero_copy_only=False) for f in (0, 1, 3, 4)] + [short, at, fine, sets]


def _two_packs(first: list[np.ndarray], second: list[np.ndarray]) -> list[np.ndarray]:
    """Both packs as one."""
    at = second[5]
    second = [*second[:5], np.where(at < 0, -1, at + len(first[6])), *second[6:]]
    return [np.concatenate(both) for both in zip(first, second)]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of hash functions on which signatures agree, less what agrees by chance."""
    same = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):
        same += x[:, None] == y[None, :]
    return (same / HASHES - 1 / 256) * (256 / 255)


def _look_again(likeness: np.ndarray, comps: np.ndarray, at: np.ndarray, fine: np.ndarray, threshold: float) -> None:
    """Strike the candidates of different components that long signatures rule out."""
    near = np.triu(likeness >= threshold - SLACK, 1) & (comps[:, None] != comps[None, :])
    x, y = np.nonzero(near & (at[:, None] >= 0) & (at[None, :] >= 0))
    for k in range(0, len(x), 4096):
        i, j = x[k : k + 4096], y[k : k + 4096]
        same = (fine[at[i]] == fine[at[j]]).mean(axis=1)
        far = (same - 1 / 256) * (256 / 255) < threshold - FINE_SLACK
        likeness[i[far], j[far]] = likeness[j[far], i[far]] = -1.0


def _possible(sizes: np.ndarray, shared: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets that share so many shingles with any other can be similar enough."""
    common = np.minimum(shared[:, None], shared[None, :])
    return common >= threshold * (sizes[:, None] + sizes[None, :] - common)


def _chain(likeness: np.ndarray, comps: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Fewest pairs that join all components as far as candidates reach, most alike first."""
    count = len(comps)
    near = np.where(likeness >= least, likeness, -1.0)
    near[comps[:, None] == comps[None, :]] = 2.0
    np.fill_diagonal(near, -1.0)
    out, left = [], np.ones(count, bool)
    best, via = np.full(count, -1.0), np.zeros(count, np.int64)
    for _ in range(count):
        scores = np.where(left, best, -2.0)
        k = int(scores.argmax())
        if 0 <= best[k] < 2.0:
            out.append((int(via[k]), k))
        left[k] = False
        closer = near[k] > best
        best[closer], via[closer] = near[k][closer], k
    return out


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the intersection of two sorted sets is so many percent of their union."""
    if min(len(x), len(y)) * 100 < max(len(x), len(y)) * percent:
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _compare(threshold: float, what: str):
    """Candidates between the two packs of each row (or inside one, if there is no second).

    ``what``: ``chain`` for as few pairs as join the components, ``all`` for all pairs of
    different components. Pairs of carried sets are given only if they are similar enough.
    """
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for k in range(batch.num_rows):
                own = _unpack(batch.column(0), k)
                cross = 0
                if batch.column(1)[k].is_valid:
                    cross = len(own[0])
                    own = _two_packs(own, _unpack(batch.column(1), k))
                ids, comps, sizes, shared, short, at, fine, sets = own
                if len(ids) < 2 or comps.min() == comps.max():
                    continue
                possible = _possible(sizes, shared, threshold)
                if cross:
                    possible[:cross, :cross] = possible[cross:, cross:] = False
                if not (possible & (comps[:, None] != comps[None, :])).any():
                    continue
                likeness = np.where(possible, _likeness(short, short), -1.0)
                _look_again(likeness, comps, at, fine, threshold)
                if what == "chain":
                    pairs = _chain(likeness, comps, threshold - SLACK)
                else:
                    likeness[comps[:, None] == comps[None, :]] = -1.0
                    pairs = np.argwhere(np.triu(likeness >= threshold - SLACK, 1)).tolist()
                pairs = [(x, y) for x, y in pairs if sets[x] is None or sets[y] is None or alike(sets[x], sets[y], percent)]
                for x, y in pairs:
                    if ids[x] != ids[y]:
                        first.append(min(ids[x], ids[y])), second.append(max(ids[x], ids[y]))
            yield batch_of(pa.array(first, pa.int64()), pa.array(second, pa.int64()))

    return run


def _inside(packs: DataFrame, threshold: float) -> DataFrame:
    rows = packs.select("members", F.lit(None).cast(packs.schema["members"].dataType).alias("others"))
    return map_batches(rows, _compare(threshold, "chain"), "a long, b long").distinct()


def _across(packs: DataFrame, threshold: float, what: str) -> DataFrame:
    """All packs of a node with each other, but for those of one and the same component."""
    counts = packs.groupBy("node").agg(F.count(F.lit(1)).alias("packs"))
    many = counts.filter("packs > 1").select(F.col("node").alias("m_node"))
    nothing = F.lit(None).cast(packs.schema["members"].dataType)
    single = packs.filter(F.col("own").isNull()).select("members", nothing.alias("others"))
    p = packs.join(many, F.col("node") == F.col("m_node"), "left_semi").select("node", "own", "slice", "members")
    q = p.toDF("q_node", "q_own", "q_slice", "others")
    place = F.struct(F.coalesce("own", F.lit(-(1 << 63))), "slice")
    q_place = F.struct(F.coalesce("q_own", F.lit(-(1 << 63))), "q_slice")
    pairs = p.join(q, (F.col("node") == F.col("q_node")) & (place < q_place))
    pairs = pairs.filter(~F.coalesce(F.col("own") == F.col("q_own"), F.lit(False)))
    rows = single.unionByName(pairs.select("members", "others"))
    return map_batches(rows, _compare(threshold, what), "a long, b long").distinct()


# ---- confirmation on full sets


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(1)):
                found = [s.tobytes() for s in shingle_sets(piece, width)]
                ids = batch.column(0).slice(piece.first, piece.rows)
                yield batch_of(ids, pa.array(found, pa.binary()))

    return run


def _confirm(threshold: float):
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in (2, 3))
                keep[k] = alike(x, y, percent)
            yield batch_of(*batch.columns[:2]).filter(pa.array(keep))

    return run


def _sets_of(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(id, shingles) for the wanted ids; ``docs``: id, text as bytes."""
    # The ids grow with the data, so they are never broadcast.
    texts = docs.join(ids.toDF("w_id").hint("merge"), F.col("id") == F.col("w_id"), "left_semi")
    return stage(map_batches(texts, _sets(width), "id long, shingles binary"), "sets")


def _shared_shingles(sets: DataFrame) -> DataFrame:
    """(id, n, shared): the size of each set and how many of its shingles another set has, too."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A list per set, unfolded by Spark, keeps the rows that leave Python few.
            lists = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            yield batch_of(batch.column(0), pa.array(lists, pa.list_(pa.int64())))

    lists = map_batches(sets, unfold, "id long, shingles array<long>")
    each = lists.select("id", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"), F.min("id").alias("id")).filter("times = 1")
    alone = alone.groupBy(F.col("id").alias("a_id")).agg(F.count(F.lit(1)).alias("alone"))
    sizes = sets.groupBy("id").agg(F.max(F.octet_length("shingles") / 8).cast("long").alias("n"))
    shared = F.col("n") - F.coalesce("alone", F.lit(0))
    return sizes.join(alone, F.col("id") == F.col("a_id"), "left").select("id", "n", shared.alias("shared"))


def _long_signatures(sets: DataFrame) -> DataFrame:
    """(id, fine, carried): long signature and, unless it is large, the set; ids of several sets get none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signature(np.frombuffer(x.as_buffer(), np.uint64), _FINE) for x in batch.column(1)]
            found = [(low & 0xFF).astype(np.uint8).tobytes() for low in found]
            small = [x.as_py() if len(x.as_buffer()) <= 8 * CARRIED else None for x in batch.column(1)]
            yield batch_of(batch.column(0), pa.array(found, pa.binary()), pa.array(small, pa.binary()))

    each = map_batches(sets, run, "id long, fine binary, carried binary")
    single = F.count(F.lit(1)) == 1
    return each.groupBy("id").agg(*[F.when(single, F.max(c)).alias(c) for c in ("fine", "carried")])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that are as similar as asked for."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    rows = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")
    return map_batches(rows, _confirm(threshold), "a long, b long").distinct()


# ---- components


def connected(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (a, b): comp is the smallest id reachable.

    Alternates large and small stars until nothing changes; each round is written, so
    a lost executor costs one round at most.
    """
    edges, seen = links.select("a", "b").filter("a <> b"), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
        # Large star: larger neighbours of u go to the smallest of u's neighbours and u.
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large, "large-star")
        # Small star: u and its smaller neighbours go to the smallest of them. Here b < a throughout.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        moved = large.join(low, F.col("a") == F.col("u"))
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        edges = stage(small.filter("a <> b").distinct(), "small-star")
        mark = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    tops = edges.select(F.col("b").alias("id")).distinct()
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(tops.select("id", F.col("id").alias("comp")))
    return stage(found, "components")


# ---- the operator


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").cast("binary").alias("text"))
    schema = "id long, n long, set_key binary, sig array<int>, short binary"
    base = stage(map_batches(texts, _describe(width), schema), "signatures")
    sets = base.filter("set_key is not null and id is not null")
    # Equal sets have equal signatures, so any row of the class will do for those.
    classes = sets.groupBy("set_key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
    classes = stage(classes, "classes")
    heads = _with_partners(classes, sets).select("set_key", "id").join(sets, ["set_key", "id"]).select("id", "sig", "short", "n")
    heads = stage(heads, "heads")
    components = _components(heads, texts, width, threshold)
    # Only classes with more than one row or with links change anything.
    found = classes.join(components.withColumnRenamed("id", "c_id"), F.col("id") == F.col("c_id"), "left")
    found = found.filter("size > 1 or comp is not null")
    found = found.select(F.col("set_key").alias("f_key"), F.coalesce("comp", "id").alias("comp"))
    rows = base.select("id", "n", "set_key").join(found, F.col("set_key") == F.col("f_key"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    rows = rows.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("component_id").isNull() | (F.col(f"`{id_column}`") == F.col("component_id")))


def _alone(rows: DataFrame, probes: int) -> DataFrame:
    """(kind, alone) of rows (kind, sig): how many of the first tokens no other kind has."""
    tokens = rows.select("kind", F.posexplode(F.slice("sig", 1, probes)).alias("place", "token"))
    tokens = tokens.groupBy("place", "token").agg(F.min("kind").alias("kind"), F.max("kind").alias("other"))
    return tokens.filter("kind = other").groupBy("kind").agg(F.count(F.lit(1)).alias("alone"))


def _with_partners(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The classes that share enough minwise tokens with others, going by token counts alone."""
    kind = F.xxhash64("set_key")
    alone = _alone(sets.select(kind.alias("kind"), "sig"), PROBES)
    out = alone.filter(F.col("alone") > PROBES - LEAST_SHARED).select(F.col("kind").alias("o_kind"))
    return classes.join(out.hint("merge"), kind == F.col("o_kind"), "left_anti")


def _with_shared_tokens(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """The ids among ``members`` that share enough of all their minwise tokens with others of them."""
    members = members.select(F.col("id").alias("kind"))
    rows = members.join(sigs.hint("merge"), F.col("kind") == F.col("g_id"))
    out = _alone(rows, HASHES).filter(F.col("alone") > HASHES - LEAST_SHARED_OF_ALL).select(F.col("kind").alias("o_kind"))
    return members.join(out.hint("merge"), F.col("kind") == F.col("o_kind"), "left_anti").select(F.col("kind").alias("id"))


def _bounds(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, n, shared) of the sets that share enough shingles with the others to be linked to one.

    What is ruled out no longer counts for the rest, so the count is repeated as long as it
    rules out half of what it looks at.
    """
    before = None
    while True:
        bounds = _shared_shingles(sets).filter(F.col("shared") >= threshold * F.col("n"))
        bounds = stage(bounds, "bounds")
        left = bounds.count()
        if left == 0 or (before is not None and 2 * left > before):
            return bounds
        before = left
        sets = sets.join(bounds.select(F.col("id").alias("b_id")).hint("merge"), F.col("id") == F.col("b_id"), "left_semi")


def _components(heads: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """(id, comp) of every linked head."""
    picks = _coordinates(DEPTH)
    # Until shingles are counted, all of a set may be shared.
    none = [F.lit(None).cast("binary").alias(c) for c in ("fine", "carried")]
    short = heads.select("id", "short", "n", F.col("n").alias("shared"), *none)
    sigs = heads.select(F.col("id").alias("g_id"), "sig")
    roots = heads.select(F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("path"), "id", "sig")
    roots = roots.withColumn("node", F.col("path").cast("long"))
    first = stage(_children(roots, 0, picks[0]).drop("parent"), "nodes")

    # Round one: chain the members of every first node, pack by pack.
    sized = stage(_unlike(_nodes(first, None)), "sizes")
    pairs = stage(_inside(_packs(first.withColumn("comp", F.col("id")), short, sized, False), threshold), "pairs")
    known = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = _sets_of(known, texts, width)
    components = connected(stage(_confirmed(pairs, sets, threshold), "links"))

    # Sets that share a node with another component, as far as their shingles allow a link.
    nodes = _nodes(first, components).select(F.col("node").alias("n_node"))
    members = first.join(nodes, F.col("node") == F.col("n_node"), "left_semi").select("id").distinct()
    members = stage(_with_shared_tokens(members, sigs), "members")
    new = members.join(sets.select(F.col("id").alias("s_id")).distinct(), F.col("id") == F.col("s_id"), "left_anti")
    new = stage(new, "ends")
    if not new.isEmpty():
        sets = sets.unionByName(_sets_of(new, texts, width))
    near = sets.join(members.toDF("m_id").hint("merge"), F.col("id") == F.col("m_id"), "left_semi")
    bounds = _bounds(near, threshold)
    left = near.join(bounds.select(F.col("id").alias("b_id")).hint("merge"), F.col("id") == F.col("b_id"), "left_semi")
    fine = stage(_long_signatures(left), "fine").withColumnRenamed("id", "f_id")
    short = short.select(F.col("id").alias("k_id"), "short").join(bounds, F.col("k_id") == F.col("id")).drop("k_id")
    short = stage(short.join(fine, F.col("id") == F.col("f_id")).drop("f_id"), "short")
    entries = first.join(bounds.select(F.col("id").alias("b_id")), F.col("id") == F.col("b_id"), "left_semi")
    entries = stage(entries, "nodes")

    # Nodes with several components left: small ones are done, large ones branch.
    leaves = []
    for level in range(1, DEPTH + 1):
        nodes = stage(_nodes(entries, components), "open")
        last = level == DEPTH
        ends = nodes if last else nodes.filter(F.col("size") <= SMALL_NODE)
        ends = ends.select(F.col("node").alias("n_node"), "size", "least", "most", "members")
        leaves.append(entries.join(ends, F.col("node") == F.col("n_node")).drop("n_node"))
        more = nodes.filter(F.col("size") > SMALL_NODE)
        if last or more.isEmpty():
            break
        wanted = more.select(F.col("node").alias("n_node"))
        parents = entries.join(wanted, F.col("node") == F.col("n_node"), "left_semi").join(sigs, F.col("id") == F.col("g_id"))
        born = stage(_children(parents, level, picks[level]), "nodes")
        stuck = stage(_stuck(more, born), "stuck")
        leaves.append(entries.join(stuck, F.col("node") == F.col("n_node")).drop("n_node"))
        entries = born.join(stuck.select("n_node"), F.col("parent") == F.col("n_node"), "left_anti").drop("parent")
    leaf = stage(reduce(DataFrame.unionByName, leaves), "leaves")
    sized = leaf.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "least", "most", "members")])
    sized = stage(_unlike(sized), "sizes")
    leaf = leaf.select("node", "path", "id")

    # Chain what is left, then compare every open pair once.
    packs = None
    for what in ("chain", "all"):
        packs = packs or stage(_packs(with_component(leaf, components), short, sized, True), "packs")
        pairs = stage(_across(packs, threshold, what), "pairs")
        if pairs.isEmpty():
            break
        links = stage(_confirmed(pairs, sets, threshold), "links")
        if not links.isEmpty():
            # Components are stars already, so few rounds join them.
            known = components.select(F.col("id").alias("a"), F.col("comp").alias("b"))
            components, packs = connected(known.unionByName(links)), None
    return components


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows whose document stands for its group, with all their columns."""
    found = near_duplicates(docs, id_column, text_column, **options)
    gone = found.filter("not kept").select(F.col(f"`{id_column}`").alias("gone_id")).distinct()
    kept = by_place(docs).join(gone, F.col(place_of(docs, id_column)) == F.col("gone_id"), "left_anti")
    return kept.toDF(*docs.columns)
