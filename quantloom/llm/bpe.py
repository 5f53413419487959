"""Byte-level BPE in both directions, on padded numpy matrices.

A text is cut into pieces by the pattern of the vocabulary.  The distinct
pieces are put into buckets of similar length, each a matrix with a row per
piece and an id per byte.  In every round each row merges its leftmost pair of
minimum rank: the ranks of all neighbouring pairs stand in a second matrix, a
merge moves what is behind it one column to the left and looks the two new
pairs up in a hash table.  Rows without a pair that merges leave the matrix, so
that rounds get cheaper.  A pair merges if its bytes together are a token, as
rank files have it, and a piece that is a token as a whole is that token.

Pieces above ``LONGEST`` bytes follow the same rule with a heap of pairs, since
a matrix would cost the square of their length.  Null texts are empty and have
no ids; nothing else is special, and strings of special tokens are plain text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.pieces import PieceCache, Vocabulary
from quantloom.llm.text import chunks, mix, release

#: Upper length of each bucket, in bytes.
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256)
LONGEST = BUCKETS[-1]
#: Cells of one matrix.
MATRIX_CELLS = 1 << 20
NO_RANK = np.int64(1 << 40)


class PairTable:
    """An open-addressing hash table from a pair of ids to the id of both together."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        size = 1 << max(4, int(4 * len(pairs)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.values = np.full(size, np.uint64(2**64 - 1)), np.full(size, NO_RANK)
        left, values = keys, np.fromiter(pairs.values(), np.int64, len(pairs))
        slot = mix(left) & self.mask
        while len(left):  # the first key of every free slot settles, the others go on to the next slot
            free = np.flatnonzero(self.keys[slot] == np.uint64(2**64 - 1))
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = left[won], values[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, values, slot = left[rest], values[rest], (slot[rest] + np.uint64(1)) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, ``NO_RANK`` where a pair does not merge or an id is below zero."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(len(keys), NO_RANK)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = mix(keys[open_]) & self.mask
        while len(open_):
            seen = self.keys[slot]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (seen != np.uint64(2**64 - 1))
            open_, slot = open_[on], (slot[on] + np.uint64(1)) & self.mask
        return out


class ByteEncoder:
    """Ids of texts by a rank file, and their bytes again."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable(ranks)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.vocabulary = Vocabulary(tokens)
        self.cache = PieceCache(lambda new: self.encode_pieces([p.encode() for p in new]))

    def _matrix(self, ids: np.ndarray, out: dict[int, np.ndarray], rows: np.ndarray) -> None:
        """Merges all rows of a matrix of ids, -1 behind the end, and hands the results to ``out``."""
        n, width = ids.shape
        ranks = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            every = np.arange(len(rows))
            best = ranks[every, at]
            done = best == NO_RANK
            if done.any():
                for row, own in zip(rows[done].tolist(), ids[done]):
                    out[row] = own[own >= 0]
                ids, ranks, rows, at, best = ids[~done], ranks[~done], rows[~done], at[~done], best[~done]
                every = np.arange(len(rows))
            if not len(rows) or ranks.shape[1] == 1:
                for row, own in zip(rows.tolist(), best.tolist()):
                    out[row] = np.array([own])
                return
            ids[every, at] = best
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.find(ids[before, at[before] - 1], ids[before, at[before]])
            behind = np.flatnonzero(at < ranks.shape[1])
            ranks[behind, at[behind]] = self.pairs.find(ids[behind, at[behind]], ids[behind, at[behind] + 1])

    def _long(self, piece: bytes) -> np.ndarray:
        """One long piece: the same merges, taken from a heap of (rank, place)."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        heap = [(r, k) for k, r in enumerate(self.pairs.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()) if r < NO_RANK]
        heapq.heapify(heap)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        size, data = [1] * len(ids), piece

        def rank(k: int) -> int | None:
            n = after[k]
            return self.ranks.get(data[k : n + size[n]]) if k >= 0 and n < len(ids) else None

        while heap:
            found, k = heapq.heappop(heap)
            if size[k] == 0 or rank(k) != found:
                continue  # one of the two has been merged otherwise
            n = after[k]
            ids[k], size[k], after[k] = found, size[k] + size[n], after[n]
            size[n] = 0
            if after[n] < len(ids):
                before[after[n]] = k
            for place in (before[k], k):
                new = rank(place)
                if new is not None:
                    heapq.heappush(heap, (new, place))
        return np.array([i for i, s in zip(ids, size) if s], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces, end to end, and how many each has."""
        out: dict[int, np.ndarray] = {}
        lengths = np.array([len(p) for p in pieces], np.int64)
        whole = [self.ranks.get(p) for p in pieces]
        for k, rank in enumerate(whole):
            if rank is not None:
                out[k] = np.array([rank])
            elif lengths[k] > LONGEST:
                out[k] = self._long(pieces[k])
        open_ = np.array([k for k in range(len(pieces)) if k not in out], np.int64)
        low = 1
        for width in BUCKETS:
            bucket = open_[(lengths[open_] > low) & (lengths[open_] <= width)]
            low = width
            step = max(1, MATRIX_CELLS // width)
            for at in range(0, len(bucket), step):
                rows = bucket[at : at + step]
                data = np.frombuffer(b"".join([pieces[k].ljust(width, b"\0") for k in rows.tolist()]), np.uint8).reshape(len(rows), width)
                ids = np.where(np.arange(width) < lengths[rows, None], self.single[data], -1)
                self._matrix(ids, out, rows)
        found = [out[k] for k in range(len(pieces))]
        return np.concatenate(found) if found else np.zeros(0, np.int64), np.array([len(f) for f in found], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and how many each has."""
        cut = [self.pattern.findall(t) for t in texts]
        ids, lengths = self.cache.lookup([p for pieces in cut for p in pieces])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum([len(pieces) for pieces in cut], dtype=np.int64)])
        return ids, np.diff(ends[bounds])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    """The encoder of a rank file, a line per token: its bytes in base64 and its rank."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return ByteEncoder(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of (doc_id, text); ``ids`` is an array of int."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for part in chunks(batches):
            ids, counts = own.encode([t or "" for t in part.column("text").to_pylist()])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data) of every row of (doc_id, ids): the bytes that the ids stand for; null ids have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path, pattern).vocabulary
        for batch in batches:
            data = [vocabulary.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of both directions: doc_id, n_tokens, ids_sha256, decoded_sha256, one row per row of (doc_id, text).

    The ids are hashed as little-endian unsigned 32-bit integers, and it is
    these bytes that are read and decoded again, in the same task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for part in chunks(batches):
            ids, counts = own.encode([t or "" for t in part.column("text").to_pylist()])
            packed = ids.astype("<u4").tobytes()
            ends = np.cumsum(counts)
            begins = ends - counts
            hashes = [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(begins.tolist(), ends.tolist())]
            back = np.frombuffer(packed, "<u4").astype(np.int64)
            data = own.vocabulary.decode(back)
            places = np.concatenate([[0], np.cumsum(own.vocabulary.lengths[back])])
            texts = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(places[begins].tolist(), places[ends].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(texts)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
