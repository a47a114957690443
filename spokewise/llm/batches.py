"""Whole texts as numpy arrays, a bounded slice of an Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Bytes of text worked on at once; a single longer text makes a slice of its own.
SLICE_BYTES = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

U64 = np.uint64


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


WHITE_SPACE = _byte_set((0x20, 0x20), (0x09, 0x0D))
# Words between white space, and words of ASCII letters, digits and all non-ASCII.
SPACED_WORDS = ~WHITE_SPACE
PLAIN_WORDS = _byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class TextSlice:
    """Rows ``first`` to ``last`` (not included) of a batch: their bytes and where each row starts."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray  # one more than rows

    @property
    def rows(self) -> int:
        return self.last - self.first


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[TextSlice]:
    """Cut a binary column into slices of about ``limit`` bytes. NULL counts as empty."""
    column = column.cast(pa.large_binary())
    rows = len(column)
    if rows == 0:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + rows + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        starts = ends[first : last + 1]
        yield TextSlice(first, last, raw[starts[0] : starts[-1]], starts - starts[0])
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Words:
    """Words of a slice in reading order: byte range, and row of each; words per row in ``row_ends``."""

    starts: np.ndarray
    ends: np.ndarray
    row_ends: np.ndarray  # words before the end of each row, with a leading 0

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row_ends)


def find_words(piece: TextSlice, word_bytes: np.ndarray) -> Words:
    """Maximal runs of ``word_bytes``; no word crosses a row."""
    inside = word_bytes[piece.data]
    size = len(inside)
    if size == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(piece.rows + 1, dtype=np.int64))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    borders = piece.starts[1:-1]
    borders = borders[(borders > 0) & (borders < size)]
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, piece.starts))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_PLACES = [mix(np.arange(1, 1025, dtype=np.uint64) * U64(0xD1B54A32D192ED03)) | U64(1)]


def _places(count: int) -> np.ndarray:
    if len(_PLACES[0]) < count:
        size = 1 << (count - 1).bit_length()
        _PLACES[0] = mix(np.arange(1, size + 1, dtype=np.uint64) * U64(0xD1B54A32D192ED03)) | U64(1)
    return _PLACES[0][:count]


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes and their places only."""
    if len(words.starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    lengths = words.ends - words.starts
    longest = int(lengths.max())
    places = _places(longest)
    hashes = np.zeros(len(lengths), dtype=np.uint64)
    # Byte by byte over all words that are long enough; a few very long words go one by one.
    order = np.argsort(-lengths, kind="stable")
    ordered, begin = lengths[order], words.starts[order]
    cut = 64
    long_words = int(np.searchsorted(-ordered, -cut, side="left"))
    for i in range(long_words):
        row = data[begin[i] : begin[i] + ordered[i]]
        hashes[i] = (_BYTE_VALUES[row] * places[: ordered[i]]).sum(dtype=np.uint64)
    values = hashes[long_words:]
    begin, ordered = begin[long_words:], ordered[long_words:]
    for place in range(min(longest, cut)):
        live = int(np.searchsorted(-ordered, -place, side="left"))
        if live == 0:
            break
        values[:live] += _BYTE_VALUES[data[begin[:live] + place]] * places[place]
    out = np.empty_like(hashes)
    out[order] = hashes
    return mix(out ^ lengths.astype(np.uint64))


def map_batches(rows: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with columns told apart by place, so that their names may be anything."""
    return rows.toDF(*[f"c{k}" for k in range(len(rows.columns))]).mapInArrow(run, schema)


def by_place(rows: DataFrame) -> DataFrame:
    """The same columns as k0, k1, ..., which clash with nothing; ``toDF`` gives the names back."""
    return rows.toDF(*[f"k{k}" for k in range(len(rows.columns))])


def place_of(rows: DataFrame, name: str) -> str:
    return f"k{rows.columns.index(name)}"


def extended(fields: list[T.StructField], **types: T.DataType) -> T.StructType:
    return T.StructType([*fields, *[T.StructField(n, t) for n, t in types.items()]])


def batch_of(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[f"c{k}" for k in range(len(columns))])
