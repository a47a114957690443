"""Benchmark decontamination with suffix arrays of the training texts.

Each slice of training texts is a shard. A task numbers its words by the benchmark's
vocabulary, sorts the suffixes that can match (those that begin with enough benchmark
words in a row) into a suffix array, and binary-searches the benchmark's suffixes in it.
A suffix matches where its first ``window`` words occur, a shorter item where all its
words do. Neighbouring matches of one item join to the longest verbatim match.

The benchmark goes to the tasks in blocks of bounded size, one pass each, so it may be
as large as one likes. The training texts are never shuffled.

Results for odd input: NULL or empty texts have no words and no match; items without
words match nothing; items with a NULL id mark words but are not listed; equal items and
repeated rows count each; an empty benchmark leaves every text clean; an empty table of
texts gives an empty result; columns of any name are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import (
    PLAIN_WORDS,
    TextSlice,
    Words,
    batch_of,
    by_place,
    extended,
    find_words,
    lower_ascii,
    map_batches,
    place_of,
    slices,
    word_hashes,
)

WINDOW = 13
# Text bytes of the benchmark that one pass searches for.
BLOCK_BYTES = 8 << 20

MATCHES = "array<struct<item:string,start:long,length:long>>"
_ARROW_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def text_words(piece: TextSlice) -> tuple[Words, np.ndarray]:
    data = lower_ascii(piece.data)
    words = find_words(TextSlice(piece.first, piece.last, data, piece.starts), PLAIN_WORDS)
    return words, word_hashes(data, words)


def _keys(ids: np.ndarray, fill: int = 0) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in word order."""
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * ids.shape[1]}").ravel()


@dataclass(frozen=True)
class Targets:
    """Benchmark suffixes: distinct windows as word numbers, and the items they begin in."""

    window: int
    shortest: int
    vocabulary: np.ndarray  # sorted word hashes; word number = place + 1
    low: np.ndarray  # sort key of each window, and the largest key that begins with it
    high: np.ndarray
    lengths: np.ndarray
    owner_ends: np.ndarray  # window -> rows of owners
    owners: np.ndarray  # item number, place in the item
    items: list[str | None]

    @staticmethod
    def of(rows: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> Targets | None:
        hashes, items = [], []
        for item, text in rows:
            for piece in slices(pa.array([text or b""], pa.binary())):
                words = text_words(piece)[1]
                if len(words):
                    hashes.append(words)
                    items.append(item)
        if not hashes:
            return None
        vocabulary = np.unique(np.concatenate(hashes))
        matrix, lengths, owners = [], [], []
        for k, words in enumerate(hashes):
            numbers = np.searchsorted(vocabulary, words) + 1
            count = max(1, len(numbers) - window + 1)
            padded = np.zeros(count + window - 1, np.int64)
            padded[: len(numbers)] = numbers
            matrix.append(np.lib.stride_tricks.sliding_window_view(padded, window)[:count])
            lengths.append(np.full(count, min(window, len(numbers))))
            owners.append(np.stack([np.full(count, k), np.arange(count)], axis=1))
        ids, lengths, owners = np.concatenate(matrix), np.concatenate(lengths), np.concatenate(owners)
        keys = _keys(ids)
        order = np.argsort(keys, kind="stable")
        first = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
        begins = np.flatnonzero(first)
        chosen = order[begins]
        high = np.where(np.arange(window) < lengths[chosen, None], ids[chosen], 0xFFFFFFFF)
        return Targets(
            window, int(lengths.min()), vocabulary, keys[chosen], _keys(high), lengths[chosen],
            np.append(begins, len(order)), owners[order], items,
        )

    def search(self, piece: TextSlice) -> tuple[np.ndarray, list[list[dict]]]:
        """Words per row, and the longest matches of each row."""
        words, hashes = text_words(piece)
        found: list[list[dict]] = [[] for _ in range(piece.rows)]
        total = len(hashes)
        if total == 0:
            return words.counts, found
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        numbers = np.where(self.vocabulary[place] == hashes, place + 1, 0)
        # How many benchmark words follow each other from each word on, inside the row.
        stops = np.where(numbers == 0, np.arange(total), total)
        inner_ends = words.row_ends[1:-1]
        closes = np.minimum.accumulate(stops[::-1])[::-1]
        row = np.searchsorted(words.row_ends, np.arange(total), side="right") - 1 if len(inner_ends) else np.zeros(total, np.int64)
        run = np.minimum(closes, words.row_ends[row + 1]) - np.arange(total)
        suffixes = np.flatnonzero(run >= self.shortest)
        if len(suffixes) == 0:
            return words.counts, found
        padded = np.concatenate([numbers, np.zeros(self.window, np.int64)])
        heads = padded[suffixes[:, None] + np.arange(self.window)]
        heads[np.arange(self.window) >= run[suffixes][:, None]] = 0
        keys = _keys(heads)
        order = np.argsort(keys, kind="stable")
        array, keys = suffixes[order], keys[order]
        left = np.searchsorted(keys, self.low, side="left")
        right = np.searchsorted(keys, self.high, side="right")
        for w in np.flatnonzero(right > left):
            owners = self.owners[self.owner_ends[w] : self.owner_ends[w + 1]]
            for at in array[left[w] : right[w]]:
                for item, offset in owners:
                    found[row[at]].append((int(item), int(at - offset), int(at), int(self.lengths[w])))
        for k, hits in enumerate(found):
            if hits:
                found[k] = self._longest(hits, int(words.row_ends[k]))
        return words.counts, found

    def _longest(self, hits: list[tuple[int, int, int, int]], base: int) -> list[dict]:
        """Join matches of one item that follow each other word by word."""
        joined: list[list[int]] = []
        for item, shift, at, length in sorted(hits):
            last = joined[-1] if joined else None
            if last and last[:2] == [item, shift] and at <= last[3]:
                last[3] = max(last[3], at + length)
            else:
                joined.append([item, shift, at, at + length])
        return [{"item": self.items[i], "start": a - base, "length": b - a} for i, _, a, b in joined]


def target_blocks(bench: DataFrame, id_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> int:
    size = bench.agg(F.sum(F.octet_length(F.col(text_column)).cast("long"))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def matched(
    docs: DataFrame,
    bench: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``__n_words`` and ``__matches`` (item, first word, words) to each text."""
    names = docs.columns if keep is None else keep
    items = bench.select(F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("text"))
    count = target_blocks(items, "item", "text", block_bytes)
    fields = [docs.schema[n] for n in names]
    schema = extended(fields, __text=T.BinaryType(), __n_words=T.LongType(), __matches=T.DataType.fromDDL(MATCHES))
    rows = docs.select(
        *[F.col(f"`{n}`") for n in names],
        F.col(f"`{text_column}`").cast("binary").alias("__text"),
        F.lit(0).cast("long").alias("__n_words"),
        F.array().cast(MATCHES).alias("__matches"),
    )
    at = len(names)
    for block in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        block_rows = part.select("item", F.col("text").cast("binary").alias("text")).collect()
        block_rows.sort(key=lambda r: (r["item"] or "", r["text"] or b""))
        targets = Targets.of([(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in block_rows], window)
        shared = docs.sparkSession.sparkContext.broadcast(targets)
        rows = map_batches(rows, _pass(shared, at), schema)
    return rows.drop("__text")


def _pass(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets = shared.value
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            matches = batch.column(at + 2).to_pylist()
            for piece in slices(batch.column(at)):
                if targets is None:
                    words, new = text_words(piece)[0].counts, None
                else:
                    words, new = targets.search(piece)
                counts[piece.first : piece.last] = words
                for k, more in enumerate(new or []):
                    if more:
                        matches[piece.first + k] = matches[piece.first + k] + more
            yield batch_of(*batch.columns[: at + 1], pa.array(counts, pa.int64()), pa.array(matches, _ARROW_MATCHES))

    return run


def hit_words(matches: Column) -> Column:
    """Words of a text inside any match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    return F.aggregate(
        spans,
        zero,
        lambda t, s: F.struct(
            F.greatest(t["end"], s["b"]).alias("end"),
            (t["hit"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], t["end"]))).alias("hit"),
        ),
        lambda t: t["hit"],
    )


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean_documents(docs: DataFrame, bench: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    plain = by_place(docs)
    found = matched(plain, bench, place_of(docs, text_column), **options)
    clean = found.filter(~is_contaminated(F.col("__n_words"), hit_words(F.col("__matches"))))
    return clean.select(*plain.columns).toDF(*docs.columns)
