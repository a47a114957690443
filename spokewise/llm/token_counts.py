"""Token counts by a linear longest-match automaton.

Words are cut greedily into the longest pieces of a public vocabulary, the first piece
of a word being one that begins with the space mark. The automaton is a trie of the
vocabulary with failure links: where no child fits, the link leads to the node of what
remains after the pieces read so far are cut off, and the number of those pieces is
precomputed for the node. Each byte is read once, and no piece is ever built.

Results for odd input: NULL or empty text, and text of white space alone, has no words
and no tokens; a word the vocabulary cannot spell counts its bytes as one token each;
repeated rows count each; an empty table gives an empty result; further columns do no
harm. Whole texts are read, however long.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from spokewise.llm.batches import SPACED_WORDS, batch_of, extended, find_words, map_batches, slices, word_hashes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Pieces of a vocabulary, at most; the automaton goes to every task.
MOST_PIECES = 500_000
# Words whose lengths a task remembers.
REMEMBERED = 1 << 20

SPACE = b" "


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a rank file: a piece in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass(frozen=True)
class Automaton:
    """Trie nodes 0 (root) .. n-1; a missing failure link is -1."""

    keys: np.ndarray  # node * 256 + byte, sorted
    values: np.ndarray  # child
    failure: np.ndarray
    popped: np.ndarray  # pieces cut off on the way to the failure node

    @staticmethod
    def of(pieces: list[bytes]) -> Automaton:
        if len(pieces) > MOST_PIECES:
            raise ValueError(f"more than {MOST_PIECES} pieces")
        children: list[dict[int, int]] = [{}]
        parents, bytes_in, ends = [-1], [0], [False]
        for piece in pieces:
            node = 0
            for b in piece:
                child = children[node].get(b)
                if child is None:
                    child = len(children)
                    children[node][b] = child
                    children.append({})
                    parents.append(node)
                    bytes_in.append(b)
                    ends.append(False)
                node = child
            ends[node] = node != 0 or ends[node]
        count = len(children)
        failure, popped = [-1] * count, [0] * count
        level = [0]
        while level:
            following = []
            for node in level:
                for b, child in children[node].items():
                    following.append(child)
                    if ends[child]:
                        failure[child], popped[child] = 0, 1
                        continue
                    # What the parent leaves over, followed until it can read the byte.
                    over, pieces_out = failure[node], popped[node]
                    while over != -1 and b not in children[over]:
                        pieces_out += popped[over]
                        over = failure[over]
                    if over != -1:
                        failure[child], popped[child] = children[over][b], pieces_out
            level = following
        keys = np.array([node * 256 + b for node in range(count) for b in children[node]], np.int64)
        values = np.array([child for node in range(count) for child in children[node].values()], np.int32)
        order = np.argsort(keys)
        return Automaton(keys[order], values[order], np.array(failure, np.int32), np.array(popped, np.int32))

    def _step(self, nodes: np.ndarray, read: np.ndarray) -> np.ndarray:
        """Children for the bytes read, -1 where there is none."""
        wanted = nodes.astype(np.int64) * 256 + read
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.values[at], -1)

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, all words a byte at a time; 0 for words that cannot be spelled.

        ``starts`` and ``ends`` are the bytes of each word without its space mark.
        """
        count = len(starts)
        if len(self.keys) == 0:
            return np.zeros(count, np.int64)
        out = np.zeros(count, np.int64)
        lost = np.zeros(count, bool)
        first = int(self._step(np.zeros(1, np.int32), np.frombuffer(SPACE, np.uint8))[0])
        if first == -1:
            return out
        order = np.argsort(starts - ends, kind="stable")  # longest first
        size, begin = (ends - starts)[order], starts[order]
        state = np.full(count, first, np.int32)
        for place in range(int(size[0]) if count else 0):
            live = int(np.searchsorted(-size, -place, side="left"))
            todo = np.flatnonzero(~lost[:live])
            read = data[begin[todo] + place].astype(np.int64)
            while len(todo):
                child = self._step(state[todo], read)
                good = child != -1
                state[todo[good]] = child[good]
                todo, read = todo[~good], read[~good]
                link = self.failure[state[todo]]
                out[todo] += self.popped[state[todo]]
                lost[todo[link == -1]] = True
                state[todo[link != -1]] = link[link != -1]
                todo, read = todo[link != -1], read[link != -1]
        # What is left at a word's end is cut up by the links, too.
        todo = np.flatnonzero(~lost & (state != 0))
        while len(todo):
            link = self.failure[state[todo]]
            out[todo] += self.popped[state[todo]]
            lost[todo[link == -1]] = True
            todo, link = todo[link != -1], link[link != -1]
            state[todo] = link
            todo = todo[link != 0]
        out[lost] = 0
        result = np.empty(count, np.int64)
        result[order] = out
        return result


class _Memory:
    """Lengths of words met before in this task, by hash, up to a bound."""

    def __init__(self) -> None:
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.hashes) == 0:
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return self.counts[at], self.hashes[at] == hashes

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > REMEMBERED:
            self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both)
        self.hashes, self.counts = both[order], np.concatenate([self.counts, counts])[order]


def count_tokens(docs: DataFrame, pieces: list[bytes], keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns ``keep``, then n_words, n_tokens and n_unknown (words the vocabulary cannot spell)."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.of(pieces))
    rows = docs.select(*[F.col(f"`{n}`") for n in keep], F.col(f"`{text_column}`").cast("binary"))
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, memory = shared.value, _Memory()
        for batch in batches:
            words_of, tokens_of, unknown_of = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for piece in slices(batch.column(at)):
                words = find_words(piece, SPACED_WORDS)
                if len(words.starts) == 0:
                    continue
                hashes, first, where = np.unique(word_hashes(piece.data, words), return_index=True, return_inverse=True)
                counts, known = memory.find(hashes)
                new = first[~known]
                counts[~known] = automaton.lengths(piece.data, words.starts[new], words.ends[new])
                memory.add(hashes[~known], counts[~known])
                own = counts[where]
                unknown = own == 0
                own = np.where(unknown, words.ends - words.starts, own)
                for target, values in ((words_of, np.ones(len(own), np.int64)), (tokens_of, own), (unknown_of, unknown)):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    target[piece.first : piece.last] = np.diff(sums[words.row_ends])
            yield batch_of(*batch.columns[:at], pa.array(words_of), pa.array(tokens_of), pa.array(unknown_of))

    longs = {n: T.LongType() for n in ("n_words", "n_tokens", "n_unknown")}
    return map_batches(rows, run, extended([docs.schema[n] for n in keep], **longs))
