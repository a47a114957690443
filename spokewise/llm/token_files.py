"""Token ids in binary files, with constant-time access by document key.

Documents are range-partitioned by key. Each task encodes its texts and appends the ids
to files of its own: a 16-byte head, then nothing but ids of two or four bytes, little
end first, document after document, each closed by an end id. A file is named after its
task attempt and counts only once the table of entries names it, so a task that is run
again, after an executor was lost or as a second attempt, leaves at most files that no
entry names.

The index maps a key to its place in those files by minimal perfect hashing. Keys are
dealt into buckets by hash, and each bucket is one index file: bit arrays tried one after
another, in each of which the keys that meet no other key find their place, the rank of
their bit being their number. Under that number stand a fingerprint, which turns away
keys that are not in the index (all but one in 2**32), the file, the offset and the
length. No key is stored, and a lookup costs a few bit tests at any size.

Results for odd input: NULL text counts as empty and has the end id alone; documents with
one key stand together in the order of their texts' hashes and are told apart by
``copy`` 0, 1, ...; a NULL key comes before all others and can be looked up as any; an
empty table gives no files and an empty result; further columns do no harm. Whole texts
are encoded, however long; one text never lies in two files.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spokewise.llm.batches import U64, batch_of, by_place, map_batches, mix, place_of
from spokewise.session import shared_folder, stage

END_ID = 2
# Ids after which a task begins a new file.
FILE_IDS = 1 << 26
# Text of one writing task, on average.
TASK_BYTES = 32 << 20
KEYS_PER_BUCKET = 1 << 17
# Ids of one file that one reading task takes, about.
READ_IDS = 1 << 22
# Bits of a level for each key that is left.
BITS_PER_KEY = 2
_MOST_LEVELS = 200
HEAD = 16
_MAGIC = b"SPWIDS1\0"
# Words and ids a task remembers, in bytes.
REMEMBERED_BYTES = 96 << 20
_ENCODE_BYTES = 500_000

# How a tokenizer that marks word ends cuts texts of printable ASCII,
# Latin-1 letters and white space in lower case, and its mark.
WORD_END = "</w>"
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+").findall
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ \t-\r]*").fullmatch
_WORDS = re.compile("[^ \t-\r]+").findall
_GAP = re.compile("[ \t-\r]").search
# Tells remembered words from parts.
_WORD = " "


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, as seen from a task, and the folder's path on it."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class Encoder:
    """Ids of texts by a public tokenizer, as bytes of two or four a piece.

    ``separator`` names a special token of a tokenizer that drops white space, lowers
    case and marks word ends, as the given one does. No rule of such a tokenizer reaches
    across white space, so that parts of a text can be encoded once each: in texts of
    printable ASCII and Latin-1 letters the parts the tokenizer itself would cut, whose
    last ids bear the mark of a word's end; in other texts the words, many at a time
    with the separator between them. Without a separator texts are encoded as they are.
    """

    def __init__(self, path: str, separator: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.separator = separator or ""
        self.cut = self.tokenizer.token_to_id(separator) if separator else None
        # The same vocabulary for parts that are cut and in lower case already.
        self.by_part = Tokenizer(self.tokenizer.model)
        self.by_part.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in found]

    def _learn(self, new: list[str], data: bytes, ends: np.ndarray, gap: int) -> None:
        """Remember the ids of ``new``, which end at ``ends``, with ``gap`` ids between them."""
        size = self.type.itemsize
        begin = 0
        for part, end in zip(new, (ends * size).tolist(), strict=True):
            self.known[part] = data[begin:end]
            begin = end + gap * size
        self.size += sum(map(len, new)) + 150 * len(new)

    def _learn_parts(self, new: list[str]) -> None:
        ids = np.array(self.by_part.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, self.type)
        self._learn(new, ids.tobytes(), np.flatnonzero(self.ends_word[ids]) + 1, 0)

    def _learn_words(self, new: list[str]) -> None:
        # A word that may hold a special token goes alone.
        plain, odd = [w for w in new if self.separator[0] not in w], [w for w in new if self.separator[0] in w]
        self.known.update((_WORD + w, i) for w, i in zip(odd, self._whole(odd)))
        if plain:
            data = self._whole([self.separator.join(plain)])[0]
            ids = np.frombuffer(data, self.type)
            self._learn([_WORD + w for w in plain], data, np.append(np.flatnonzero(ids == self.cut), len(ids)), 1)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        decoded = [t.decode("utf-8", "replace") for t in texts]
        if self.cut is None:
            return self._whole(decoded)
        out = [[] for _ in texts]
        for owners, pieces in _rounds(decoded):
            if self.size > REMEMBERED_BYTES:
                self.known, self.size = {}, 0
            simple = [_SIMPLE(p) is not None and self.separator[0] not in p for p in pieces]
            cut = [_PARTS(p.lower()) if s else [_WORD + w for w in _WORDS(p)] for p, s in zip(pieces, simple)]
            get = self.known.get
            found = [list(map(get, parts)) for parts in cut]
            new: dict[bool, set[str]] = {True: set(), False: set()}
            for parts, ids, s in zip(cut, found, simple):
                if None in ids:
                    new[s].update(p for p, i in zip(parts, ids) if i is None)
            if new[True]:
                self._learn_parts(list(new[True]))
            if new[False]:
                self._learn_words([w[len(_WORD) :] for w in new[False]])
            for owner, parts, ids in zip(owners, cut, found):
                out[owner].append(b"".join(map(get, parts) if None in ids else ids))
        return [b"".join(o) for o in out]


def _rounds(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts with their numbers, a bounded length at a time; longer ones are cut at white space."""
    owners, pieces, size = [], [], 0
    for owner, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            gap = _GAP(text, begin + _ENCODE_BYTES)
            end = gap.start() if gap else len(text)
            owners.append(owner)
            pieces.append(text[begin:end] if end - begin < len(text) else text)
            size, begin = size + end - begin, end
            if size >= _ENCODE_BYTES:
                yield owners, pieces
                owners, pieces, size = [], [], 0
    if pieces:
        yield owners, pieces


@lru_cache(maxsize=2)
def _encoder(path: str, separator: str | None) -> Encoder:
    """One encoder a process, so that tasks that follow one another share what it has learnt."""
    return Encoder(path, separator)


@dataclass(frozen=True)
class TokenFiles:
    """A written dataset: its folder, the width of an id, the table of entries and the table of index files."""

    folder: str
    width: int
    entries: DataFrame  # key, copy, file, first, n, start
    files: DataFrame  # file, name
    index: DataFrame | None  # bucket, name, keys
    buckets: int


def _writer(folder: str, path: str, separator: str | None, file_ids: int, key_field: T.StructField):
    """Write a partition's rows (key, text) to files; one row per document about where it went."""
    head = pa.field("k", pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path, separator), TaskContext.get().partitionId()
        system, root = open_folder(folder)
        out, name, number, written, row, last, copy = None, "", -1, 0, 0, (), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            begin = 0
            while begin < len(texts):
                group, size = [], 0
                while begin + len(group) < len(texts) and (not group or size < _ENCODE_BYTES):
                    group.append(texts[begin + len(group)].as_py() or b"")
                    size += len(group[-1])
                names, numbers, rows, copies, firsts, counts = [], [], [], [], [], []
                for at, ids in enumerate(encoder.ids(group)):
                    if out is None or written >= file_ids:
                        if out is not None:
                            out.close()
                        number, written, name = number + 1, 0, f"part-{part}-{number + 1}-{uuid.uuid4().hex}.ids"
                        out = system.open_output_stream(f"{root}/{name}")
                        out.write(_MAGIC + bytes([encoder.type.itemsize]).ljust(HEAD - len(_MAGIC), b"\0"))
                    ids += np.array([END_ID], encoder.type).tobytes()
                    out.write(ids)
                    key = (keys[begin + at].as_py(),)
                    copy = copy + 1 if key == last else 0
                    last, count = key, len(ids) // encoder.type.itemsize
                    for values, value in zip((names, numbers, rows, copies, firsts, counts), (name, number, row, copy, written, count)):
                        values.append(value)
                    written, row = written + count, row + 1
                longs = [pa.array(v, head.type) for v in (numbers, rows, copies, firsts, counts)]
                yield batch_of(keys[begin : begin + len(group)], pa.array([part] * len(group), head.type), pa.array(names, pa.string()), *longs)
                begin += len(group)
        if out is not None:
            out.close()

    names = ("part", "name", "number", "row", "copy", "first", "n")
    kinds = {n: T.StringType() if n == "name" else T.LongType() for n in names}
    return run, T.StructType([T.StructField("key", key_field.dataType), *[T.StructField(n, k) for n, k in kinds.items()]])


def write(
    docs: DataFrame,
    tokenizer: str,
    separator: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    folder: str | None = None,
    file_ids: int = FILE_IDS,
    keys_per_bucket: int = KEYS_PER_BUCKET,
    tasks: int | None = None,
) -> TokenFiles:
    """Encode and write all documents in key order, then index them."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    system, root = open_folder(folder)
    system.create_dir(root)
    plain = by_place(docs)
    key, text = F.col(place_of(docs, id_column)), F.col(place_of(docs, text_column))
    rows = plain.select(key.alias("key"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    if tasks is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc(), F.length("text").asc()]
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    run, schema = _writer(folder, tokenizer, separator, file_ids, docs.schema[id_column])
    written = stage(map_batches(rows, run, schema), "token-entries")
    # Rows of one key that continue in a later partition: only the keys at the partitions' heads can.
    heads = written.filter("row = 0").select("key", F.lit(True).alias("heads")).distinct()
    ends = written.groupBy("part", "key").agg(F.max("copy").alias("top")).join(heads, written["key"].eqNullSafe(heads["key"]), "left_semi")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", "key", F.coalesce(F.sum(F.col("top") + 1).over(before), F.lit(0)).alias("carried")).filter("carried > 0")
    carried = stage(carried.select(F.col("part").alias("c_part"), F.col("key").alias("c_key"), "carried"), "token-carried")
    # One row per file.
    files = written.groupBy("part", "number", "name").agg(F.sum("n").alias("ids"))
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        "name", "ids", (F.row_number().over(Window.orderBy("part", "number")) - 1).alias("file"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base")
    )
    files = stage(files, "token-files")
    entries = written.join(files.drop("ids"), "name").join(
        carried, (F.col("part") == F.col("c_part")) & F.col("key").eqNullSafe(F.col("c_key")), "left"
    )
    entries = entries.select(
        "key",
        (F.col("copy") + F.coalesce("carried", F.lit(0))).alias("copy"),
        F.col("file").cast("long").alias("file"),
        "first",
        "n",
        (F.col("base") + F.col("first")).alias("start"),
    )
    entries = stage(entries, "token-index")
    buckets = max(1, -(-entries.count() // keys_per_bucket))
    index = stage(_indexed(entries, folder, buckets), "token-buckets")
    width = 2 if _encoder(tokenizer, separator).type.itemsize == 2 else 4
    return TokenFiles(folder, width, entries, files.select("file", "name"), index, buckets)


def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    """Add two 64-bit hashes of (key, copy), ``h1`` and ``h2``, and the bucket."""
    of: list[Column] = [F.col("key").isNull(), F.col("key"), F.col("copy").cast("long")]
    keys = keys.withColumns({"h1": F.xxhash64(F.lit(1), *of), "h2": F.xxhash64(F.lit(2), *of)})
    return keys.withColumn("bucket", F.pmod(F.xxhash64("h1", "h2"), F.lit(buckets)).cast("long"))


class PerfectHash:
    """Numbers 0 .. n-1 for n keys given by two hashes each; other keys get any number or -1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits  # 64-bit words per level, and the words of all levels
        counts = np.bitwise_count(bits).astype(np.int64)
        self.ranks = np.cumsum(counts) - counts
        self.begins = np.cumsum(sizes) - sizes

    @staticmethod
    def _place(h1: np.ndarray, h2: np.ndarray, level: int, words: int) -> np.ndarray:
        return (mix(h1 + U64(level) * (h2 | U64(1))) % U64(words * 64)).astype(np.int64)

    @staticmethod
    def of(h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, bits = [], [np.zeros(0, np.uint64)]
        while len(h1):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("keys with equal hashes")
            words = -(-len(h1) * BITS_PER_KEY // 64)
            places = PerfectHash._place(h1, h2, len(sizes), words)
            alone = np.bincount(places, minlength=words * 64) == 1
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(words)
            met = ~alone[places]
            h1, h2 = h1[met], h2[met]
        return PerfectHash(np.array(sizes, np.int64), np.concatenate(bits))

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, words in enumerate(self.sizes):
            if len(todo) == 0:
                break
            places = self._place(h1[todo], h2[todo], level, int(words))
            at, bit = self.begins[level] + (places >> 6), (places & 63).astype(np.uint64)
            word = self.bits[at]
            hit = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
            out[todo[hit]] = (self.ranks[at] + below)[hit]
            todo = todo[~hit]
        return out


VALUES = ("file", "first", "n", "start")


@dataclass(frozen=True)
class Index:
    """One bucket of the index: values by number, and fingerprints against strange keys."""

    hashes: PerfectHash
    marks: np.ndarray
    values: dict[str, np.ndarray]

    @staticmethod
    def _marks(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return (mix(h2 ^ (h1 << U64(1))) >> U64(32)).astype(np.uint32)

    @staticmethod
    def of(h1: np.ndarray, h2: np.ndarray, values: dict[str, np.ndarray]) -> Index:
        hashes = PerfectHash.of(h1, h2)
        order = np.empty(len(h1), np.int64)
        order[hashes.find(h1, h2)] = np.arange(len(h1))
        return Index(hashes, Index._marks(h1, h2)[order], {n: v[order] for n, v in values.items()})

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for a key that is not here."""
        at = self.hashes.find(h1, h2)
        if len(self.marks):
            at[self.marks[at] != self._marks(h1, h2)] = -1
        return at

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for part in (self.hashes.sizes, self.hashes.bits, self.marks, *[self.values[n] for n in VALUES]):
            np.save(out, part, allow_pickle=False)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Index:
        parts = io.BytesIO(data)
        sizes, bits, marks, *values = [np.load(parts, allow_pickle=False) for _ in range(3 + len(VALUES))]
        return Index(PerfectHash(sizes, bits), marks, dict(zip(VALUES, values)))


def _indexed(entries: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write one index file per bucket; a bucket holds about the same number of keys at any size of the table."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (group[h].to_numpy().view(np.uint64) for h in ("h1", "h2"))
        index = Index.of(h1, h2, {n: group[n].to_numpy() for n in VALUES})
        system, root = open_folder(folder)
        name = f"index-{key[0]}-{uuid.uuid4().hex}.mph"
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(index.to_bytes())
        return pd.DataFrame({"bucket": [key[0]], "name": [name], "keys": [len(group)]})

    hashed = _hashed(entries, buckets).drop("key", "copy")
    return hashed.groupBy("bucket").applyInPandas(build, "bucket long, name string, keys long")


def lookup(data: TokenFiles, keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` (key, copy) that the dataset holds, with file, first, n and start from the index."""
    names = data.index.select(F.col("bucket").alias("i_bucket"), "name")
    rows = _hashed(keys.select("key", "copy"), data.buckets)
    rows = rows.join(names, F.col("bucket") == F.col("i_bucket")).select("key", "copy", "h1", "h2", "name")
    # One key asked for many times is spread, as is any bucket: a task opens the buckets it meets.
    rows = rows.repartition("name", F.pmod("h1", F.lit(16))).sortWithinPartitions("name")
    folder, schema = data.folder, T.StructType([keys.schema["key"], *[T.StructField(n, T.LongType()) for n in ("copy", *VALUES)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        opened, index = None, None
        for batch in batches:
            names = batch.column(4).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else []
            for a, b in zip(cuts, cuts[1:]):
                if names[a] != opened:
                    with system.open_input_stream(f"{root}/{names[a]}") as source:
                        opened, index = names[a], Index.from_bytes(source.read())
                part = batch.slice(a, b - a)
                h1, h2 = (part.column(k).to_numpy().view(np.uint64) for k in (2, 3))
                at = index.find(h1, h2)
                known = pa.array(np.flatnonzero(at >= 0))
                found = [pa.array(index.values[n][at[at >= 0]], pa.int64()) for n in VALUES]
                yield batch_of(part.column(0).take(known), part.column(1).cast(pa.int64()).take(known), *found)

    return map_batches(rows, run, schema)


def read(data: TokenFiles, found: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the payload of looked-up rows: key, copy, start, n_tokens, ids_crc32 and, on request, ``ids``."""
    places = found.join(data.files, "file").select("key", "copy", "start", "n", "first", "name")
    places = places.repartition("name", F.floor(F.col("first") / READ_IDS)).sortWithinPartitions("name", "first")
    folder, width = data.folder, data.width
    fields = [found.schema["key"], *[T.StructField(n, T.LongType()) for n in ("copy", "start", "n_tokens", "ids_crc32")]]
    schema = T.StructType(fields + ([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        opened, source = None, None
        for batch in batches:
            sums, ids = [], []
            for n, first, name in zip(*[batch.column(k).to_pylist() for k in (3, 4, 5)]):
                if name != opened:
                    if source is not None:
                        source.close()
                    opened, source = name, system.open_input_file(f"{root}/{name}")
                    if source.read(HEAD)[: len(_MAGIC) + 1] != _MAGIC + bytes([width]):
                        raise ValueError(f"not a file of ids: {name}")
                source.seek(HEAD + first * width)
                raw = np.frombuffer(source.read(n * width), f"<u{width}")
                sums.append(zlib.crc32(raw.astype("<u4").tobytes()))
                if with_ids:
                    ids.append(raw.astype(np.int64))
            more = [pa.array(ids, pa.list_(pa.int64()))] if with_ids else []
            yield batch_of(*batch.columns[:4], pa.array(sums, pa.int64()), *more)
        if source is not None:
            source.close()

    return map_batches(places, run, schema)


def round_trip(docs: DataFrame, tokenizer: str, separator: str | None = None, id_column: str = "doc_id", **options) -> DataFrame:
    """Write the documents, then look every one of them up and read it back from the files."""
    data = write(docs, tokenizer, separator, id_column, **options)
    found = read(data, lookup(data, data.entries.select("key", "copy")))
    return found.select(F.col("key").alias(id_column), "start", "n_tokens", "ids_crc32")
