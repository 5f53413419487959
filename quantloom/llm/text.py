"""Tokens of Arrow string batches as numpy arrays of 64-bit hashes.

A word is decided byte by byte: every byte of a non-ASCII character is 0x80 or
more, so both word classes below can be read off UTF-8 without decoding.  A
word's hash is a polynomial over its ASCII-lower-cased bytes modulo 2**64,
finished by a mixer; two of a billion different words collide with a
probability of about 3 %, two words of one document practically never.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, bool)
SPACED[9:14] = SPACED[32] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], np.uint64))[0])


_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        _powers[:] = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=np.uint64))
    return _powers[0], _powers[1]


@dataclass
class Tokens:
    """All tokens of a batch in order; ``bounds[i]:bounds[i + 1]`` are those of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending byte spans, worked off in pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, origin + CHUNK_BYTES, "right")))
        piece = LOWER[data[origin : ends[to - 1]]].astype(np.uint64) + np.uint64(1)
        powers, inverse = _tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * powers[: len(piece)], out=sums[1:])
        s, e = starts[at:to] - origin, ends[at:to] - origin
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s])
        at = to
    return out


def tokenise(column: pa.Array, word: np.ndarray = ALNUM) -> Tokens:
    data, offsets = raw_bytes(column)
    inside = word[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Tokens(hash_spans(data, starts, ends), starts, ends, np.searchsorted(starts, offsets), data)


def word_hash(word: str) -> int:
    return int(tokenise(pa.array([word]), SPACED).hashes[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into slices of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def release() -> None:
    """Gives memory that a worker no longer needs back to the system; workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries return it by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def windowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` tokens; the caller drops those across texts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= np.uint64(_BASE)
        out += hashes[k : k + n]
    return mix(out)
