"""Ids of text pieces that come again and again: every distinct piece of a worker is encoded once.

Most pieces of running text are repeats.  ``PieceCache`` numbers the distinct
ones and keeps their ids end to end, so that the ids of a whole batch are one
gather.  It is emptied between batches as soon as it exceeds its bounds.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

MAX_PIECES = 300_000
MAX_IDS = 4_000_000


def spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``begin .. begin + length - 1`` of all stretches, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


class PieceCache:
    """Ids of pieces; ``encode`` gives the ids of a list of new pieces, end to end, and how many each has."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], max_pieces: int | None = None) -> None:
        self.encode, self.max_pieces = encode, max_pieces or MAX_PIECES
        self._empty()

    def _empty(self) -> None:
        self.known: dict = {}
        self.ids, self.begins = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def lookup(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces end to end, and how many ids each piece has."""
        if len(self.known) > self.max_pieces or len(self.ids) > MAX_IDS:
            self._empty()
        own = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(own < 0).tolist()
        if missing:
            new = list({pieces[k] for k in missing})
            ids, lengths = self.encode(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths)])
            self.ids = np.concatenate([self.ids, ids])
            own[missing] = [self.known[pieces[k]] for k in missing]
        begins = self.begins[own]
        lengths = self.begins[own + 1] - begins
        return self.ids[spread(begins, lengths)], lengths


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, end to end."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))
