"""Exact duplicates by two-pass Bloom filtering.

Pass one sets bits for every text's hash and notes bits set more than once. Pass two
asks, row by row and without moving it, whether all bits of a row's hash were set more
than once. Only if so can the text occur twice. Those rows alone shuffle, and are then
compared by their full SHA-256; all others pass straight through. The filter's size
follows the number of rows up to ``max_bits``. Beyond that more rows shuffle in vain,
but the result stays the same.

Texts are equal when they are identical after lower-casing A-Z. The row with the
largest id stays. Results for odd input: NULL text counts as empty; a NULL id is
smaller than any other; of several rows with equal text and the same largest id exactly
one stays; an empty table gives an empty result; further columns do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from spokewise.llm.batches import batch_of, by_place, extended, map_batches, place_of
from spokewise.session import stage

BITS_PER_ROW = 16
# Largest filter that is sent to all tasks: 32 MB.
MAX_BITS = 1 << 28
MIN_BITS = 1 << 16
BLOCK_BITS = 1 << 20
PROBES = 2
# Hashes that a task gathers before it hands its marks on.
FLUSH_ROWS = 1 << 20
_MERGE_SLICES = 32

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def normal_digest(text: bytes | None) -> bytes:
    """SHA-256 of a UTF-8 text with A-Z in lower case. No byte of another character is in that range."""
    return hashlib.sha256((text or b"").translate(_LOWER)).digest()


def with_digest(docs: DataFrame, text_column: str, keep: list[str], shared: Broadcast | None = None) -> DataFrame:
    """The columns ``keep``, then ``__digest`` and, given a filter, ``__maybe``."""
    rows = docs.select(*[F.col(f"`{n}`") for n in keep], F.col(f"`{text_column}`").cast("binary").alias("__text"))
    flags = {} if shared is None else {"__maybe": T.BooleanType()}
    schema = extended([docs.schema[n] for n in keep], __digest=T.BinaryType(), **flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            digests = pa.array([normal_digest(t.as_py()) for t in texts], pa.binary())
            maybe = [] if shared is None else [pa.array(_maybe(shared.value, digests))]
            yield batch_of(*batch.columns[: len(keep)], digests, *maybe)

    return map_batches(rows, run, schema)


def _places(digests: pa.Array, bits: int) -> np.ndarray:
    """The filter bits of each digest, one row per digest."""
    if len(digests) == 0:
        return np.zeros((0, PROBES), np.int64)
    raw = np.frombuffer(b"".join(digests.to_pylist()), dtype="<u8").reshape(len(digests), 4)
    return (raw[:, :PROBES] & np.uint64(bits - 1)).astype(np.int64)


def _marks(bits: int):
    block_bits = min(bits, BLOCK_BITS)

    def flush(found: list[np.ndarray], salt: int) -> Iterator[pa.RecordBatch]:
        places, counts = np.unique(np.concatenate(found), return_counts=True)
        blocks = places // block_bits
        begins = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
        ends = np.append(begins[1:], len(blocks))
        inner, more = (places % block_bits).astype(np.uint32), counts > 1
        yield batch_of(
            pa.array(blocks[begins], pa.int64()),
            pa.array(np.full(len(begins), salt), pa.int32()),
            pa.array([inner[a:b][~more[a:b]].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            pa.array([inner[a:b][more[a:b]].tobytes() for a, b in zip(begins, ends)], pa.binary()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows, salt = [], 0, 0
        for batch in batches:
            # A digest that fills one bit twice counts once there.
            places = _places(batch.column(0), bits)
            if len(places) == 0:
                continue
            salt = (salt + int(places[0, 0])) % _MERGE_SLICES
            same = places[:, 0] == places[:, 1]
            found += [places[:, 0], places[~same, 1]]
            rows += len(places)
            if rows >= FLUSH_ROWS:
                yield from flush(found, salt)
                found, rows = [], 0
        if found:
            yield from flush(found, salt)

    return run


def _merge(bits: int):
    """Add up marks of one block: a bit marked by two parties was set more than once."""
    block_bits = min(bits, BLOCK_BITS)

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        times = np.zeros(block_bits, np.uint8)
        for once, more in zip(group["once"], group["more"]):
            at = np.frombuffer(once, np.uint32)
            times[at] = np.minimum(times[at] + 1, 2)
            times[np.frombuffer(more, np.uint32)] = 2
        once, more = (np.flatnonzero(times == k).astype(np.uint32).tobytes() for k in (1, 2))
        return pd.DataFrame({"block": [key[0]], "once": [once], "more": [more]})

    return run


def repeated_bits(digests: DataFrame, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> np.ndarray:
    """Pass one over a table with one column, the digest: the bits set more than once."""
    rows = digests.count()
    bits = max(MIN_BITS, 1 << max(rows * bits_per_row - 1, 1).bit_length())
    bits = min(bits, max_bits)
    block_bits = min(bits, BLOCK_BITS)
    marks = map_batches(digests, _marks(bits), "block long, salt int, once binary, more binary")
    out = "block long, once binary, more binary"
    sliced = marks.groupBy("block", "salt").applyInPandas(_merge(bits), out)
    merged = sliced.groupBy("block").applyInPandas(_merge(bits), out).select("block", "more")
    filled = np.zeros(bits, bool)
    for row in merged.toLocalIterator():
        filled[row["block"] * block_bits + np.frombuffer(row["more"], np.uint32)] = True
    return np.packbits(filled, bitorder="little")


def _maybe(packed: np.ndarray, digests: pa.Array) -> np.ndarray:
    places = _places(digests, len(packed) * 8)
    return (((packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1) == 1).all(axis=1)


def _flagged(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """Pass two: add ``__maybe`` to rows that end with their digest."""
    at = len(rows.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = pa.array(_maybe(shared.value, batch.column(at)))
            yield batch_of(*batch.columns, flags)

    return map_batches(rows, run, extended(rows.schema.fields, __maybe=T.BooleanType()))


def _filter_of(digests: DataFrame, bits_per_row: int, max_bits: int) -> Broadcast:
    bits = repeated_bits(digests.select("__digest"), bits_per_row, max_bits)
    return digests.sparkSession.sparkContext.broadcast(bits)


def exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    digests = with_digest(docs, text_column, [id_column])
    # The tag tells rows with equal ids apart; it is fixed by being written.
    digests = stage(digests.select(F.col(f"`{id_column}`").alias("id"), F.monotonically_increasing_id().alias("tag"), "__digest"), "digests")
    rows = _flagged(digests, _filter_of(digests, bits_per_row, max_bits))
    alone = rows.filter("not __maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "__digest"
    )
    again = rows.filter("__maybe")
    groups = again.groupBy("__digest").agg(F.max(F.struct("id", "tag")).alias("top"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join below shuffles both sides alike and a large group can be split.
    groups = stage(groups, "groups")
    grouped = again.join(groups, "__digest").select(
        "id", F.col("top.id").alias("keep_id"), "group_size", (F.col("tag") == F.col("top.tag")).alias("kept"), "__digest"
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("__digest")).alias("text_sha256")
    )


def drop_exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows that stay, with all their columns. Rows that cannot repeat are never moved."""
    digests = stage(with_digest(docs, text_column, []), "digests")
    shared = _filter_of(digests, bits_per_row, max_bits)
    plain = by_place(docs)
    # One pass through Python, not two: each costs every executor a worker process per task.
    rows = with_digest(plain, place_of(docs, text_column), plain.columns, shared)
    # Equal ids: any one rule will do, as long as reruns agree.
    hashed = [f.name for f in plain.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    own_id = F.col(place_of(docs, id_column)).cast("long")
    rank: Column = F.struct(F.coalesce(own_id, F.lit(-(1 << 63))), F.xxhash64(*hashed))
    top = rows.filter("__maybe").groupBy("__digest").agg(F.max_by(F.struct(*plain.columns), rank).alias("__row"))
    kept = rows.filter("not __maybe").select(*plain.columns).unionAll(top.select("__row.*"))
    return kept.toDF(*docs.columns)
