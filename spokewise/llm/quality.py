"""Quality classifier by supervised subword embeddings.

Every word and every character n-gram is hashed to a learned vector; a word that repeats
the one before it adds a vector of its own. A text is the average of its vectors, and a softmax over two classes reads the average. The vectors
are trained by plain stochastic gradient descent in numpy on a bounded sample of
labelled texts; scoring reads every whole text inside its own task.

Results for odd input: a NULL or empty text has only the bias vector and gets the score
of that; labels that are NULL or belong to no text are ignored; several labels of one
document count as their majority, a tie as 0; with labels of one class only, or none,
all scores are that class' share (0.5 without labels). Other columns, whatever their
names, are passed through. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import TextSlice, batch_of, extended, map_batches, slices

BUCKETS = 1 << 18
DIMENSIONS = 8
GRAMS = (3, 4, 5)
# Labelled texts per class that the model is fitted on, at most.
SAMPLE_PER_CLASS = 3000
EPOCHS = 4
RATE = 1.0
THRESHOLD = 0.7
# Two buckets besides the hashed ones: the bias, which every text has once, and a word that repeats its predecessor.
BIAS = BUCKETS
REPEAT = BUCKETS + 1

_FNV = np.uint32(16777619)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h = h * np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h & np.uint32(BUCKETS - 1)


def features(piece: TextSlice) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hashed features of a slice, and the start of each row.

    Each entry is a bucket for every character of the slice and whether a feature
    begins there. A gram may begin or end with white space but not contain it, so
    grams at word borders differ from inner ones and none spans two texts.
    """
    # Every row has a line break of its own before it, which the next row's break ends.
    rows = [piece.data[a:b].tobytes() for a, b in zip(piece.starts[:-1], piece.starts[1:])]
    joined = b"\n" + b"\n".join(rows) + b"\n"
    chars = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    # Where rows start, in characters: bytes that do not continue a character are counted.
    raw = np.frombuffer(joined, dtype=np.uint8)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts = before[piece.starts + np.arange(len(piece.starts))]
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    padded = np.concatenate([chars, np.full(max(GRAMS), 10, np.uint32)])
    blank = np.concatenate([space, np.ones(max(GRAMS), bool)])
    size = len(chars)
    found = []
    h = np.full(size, 2166136261, np.uint32)
    clear = np.ones(size, bool)
    for n in range(1, max(GRAMS) + 1):
        h = (h ^ padded[n - 1 : n - 1 + size]) * _FNV
        if n >= 3:
            clear = clear & ~blank[n - 2 : n - 2 + size]
        if n in GRAMS:
            found.append((_bucket(h ^ np.uint32(n)), clear & ~(space & blank[n - 1 : n - 1 + size])))
    # Words: a running product over the word, read where the word ends.
    opens = ~space
    opens[1:] &= space[:-1]
    at = np.flatnonzero(opens)
    ends = np.flatnonzero(~space & blank[1 : size + 1]) + 1
    place = np.arange(size, dtype=np.uint32)
    if len(at):
        place -= np.repeat(at, np.diff(np.append(at, size))).astype(np.uint32) if at[0] == 0 else np.concatenate(
            [np.zeros(at[0], np.uint32), np.repeat(at, np.diff(np.append(at, size))).astype(np.uint32)]
        )
    values = (chars + np.uint32(1)) * (place * np.uint32(0x9E3779B1) | np.uint32(1))
    values[space] = 0
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=sums[1:])
    word = np.zeros(size, np.uint32)
    own = _bucket((sums[ends] - sums[at]).astype(np.uint32) ^ np.uint32(0x85EBCA6B))
    word[at] = own
    found.append((word, opens))
    # All word pairs of the kind "the same word again" share one bucket.
    again = np.zeros(size, bool)
    row = np.searchsorted(starts, at, side="right")
    again[at[1:]] = (own[1:] == own[:-1]) & (row[1:] == row[:-1])
    found.append((np.full(size, REPEAT, np.uint32), again))
    return found, starts


def sparse_features(piece: TextSlice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their counts, row by row, the bias included."""
    found, starts = features(piece)
    for a, b in zip(starts[:-1], starts[1:]):
        buckets = np.concatenate([h[a:b][ok[a:b]] for h, ok in found])
        ids, counts = np.unique(buckets, return_counts=True)
        yield np.append(ids, BIAS).astype(np.int32), np.append(counts, 1).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """Trained vectors, folded with the output layer to one weight per bucket."""

    weights: np.ndarray
    share: float | None = None  # the score of every text if there was nothing to learn

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        if self.share is not None:
            out[:] = self.share
            return out
        for piece in slices(column):
            found, starts = features(piece)
            sums = np.full(piece.rows, float(self.weights[BIAS]))
            counts = np.ones(piece.rows)
            begin = starts[:-1]
            for buckets, ok in found:
                value = self.weights[buckets]
                value[~ok] = 0
                sums += np.add.reduceat(value, begin, dtype=np.float64)
                counts += np.add.reduceat(ok, begin, dtype=np.int64)
            out[piece.first : piece.last] = 1 / (1 + np.exp(-np.clip(sums / counts, -50, 50)))
        return out


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int, float]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7
) -> QualityModel:
    """Fit vectors and softmax on rows of (buckets, counts, class, weight)."""
    classes = {row[2] for row in rows}
    if len(classes) < 2:
        return QualityModel(np.zeros(BUCKETS + 2, np.float32), float(classes.pop()) if classes else 0.5)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 2, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            ids, counts, label, weight = rows[k]
            share = counts / counts.sum()
            own = vectors[ids]
            mean = share @ own
            z = output @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            pull = (rate * (1 - step / steps) * weight) * p
            back = pull @ output
            output -= np.outer(pull, mean)
            # The average spreads one gradient over all vectors of the text.
            vectors[ids] = own - np.outer(share, back) * np.float32(len(ids)) ** np.float32(0.5)
            step += 1
    return QualityModel(vectors @ (output[1] - output[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    use: Column | None = None,
    per_class: int = SAMPLE_PER_CLASS,
) -> QualityModel:
    """Train on at most ``per_class`` labelled texts of each class, chosen by a hash of the id.

    ``use`` restricts the labelled ids (a condition on ``id_column``). Of several rows
    with one id one is taken. A single task trains on the sample, whose number of texts
    does not grow with the data.
    """
    known = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("double").alias("__y"))
    known = known.filter("__id is not null and __y is not null")
    known = known.groupBy("__id").agg((F.avg("__y") > 0.5).cast("int").alias("__label"))
    if use is not None:
        known = known.withColumnRenamed("__id", id_column).filter(use).withColumnRenamed(id_column, "__id")
    sizes = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    order = F.xxhash64(F.lit(11), "__id")
    chosen = None
    for label in sorted(sizes):
        part = known.filter(F.col("__label") == label).orderBy(order, "__id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return train([])
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).cast("binary").alias("__text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels_of = batch.column(1).to_pylist()
            for piece in slices(batch.column(0)):
                rows = list(sparse_features(piece))
                yield batch_of(
                    pa.array(labels_of[piece.first : piece.last], pa.int32()),
                    pa.array([ids.tobytes() for ids, _ in rows], pa.binary()),
                    pa.array([counts.tobytes() for _, counts in rows], pa.binary()),
                )

    # One row per id, so that the sample is bounded; the hash makes the choice the same in every run.
    sample = texts.join(chosen, "__id").groupBy("__id", "__label").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    rows = map_batches(sample.select("__text", "__label"), extract, "label int, ids binary, counts binary")
    total = sum(sizes.values())

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns])]
        # Ordered by content, so that reruns train alike whatever the partitions were.
        rows.sort()
        seen = {k: sum(label == k for label, _, _ in rows) for k in sizes}
        scale = {k: (sizes[k] / total) * (len(rows) / max(seen[k], 1)) for k in sizes}
        model = train(
            [(np.frombuffer(i, np.int32), np.frombuffer(c, np.float32), label, np.float32(scale[label])) for label, i, c in rows]
        )
        yield batch_of(pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.share], pa.float64()))

    # Trained in one task, which holds the sample; the driver gets the weights alone.
    found = map_batches(rows.repartition(1), learn, "weights binary, share double").first()
    return QualityModel(np.frombuffer(found["weights"], np.float32), found["share"]) if found else train([])


def score(
    docs: DataFrame,
    model: QualityModel,
    text_column: str = "text",
    keep: list[str] | None = None,
    threshold: float = THRESHOLD,
    only_good: bool = False,
) -> DataFrame:
    """Add ``score`` and ``predicted`` to each row, or keep only the rows predicted good.

    With ``only_good`` the columns stay as they are. The model has a fixed size and
    goes to every task.
    """
    names = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is passed through anyway goes to Python once.
    own = names.index(text_column) if text_column in names else len(names)
    extra = [] if own < len(names) else [_quoted(text_column)]
    source = docs.select(*[_quoted(n) for n in names], *extra)
    fields = [docs.schema[n] for n in names]
    schema = T.StructType(fields) if only_good else extended(fields, score=T.DoubleType(), predicted=T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(batch.column(own))
            good = values >= threshold
            if only_good:
                yield batch.filter(pa.array(good)).select(list(range(len(names))))
            else:
                yield batch_of(*batch.columns[: len(names)], pa.array(values), pa.array(good.astype(np.int32)))

    return map_batches(source, run, schema)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
