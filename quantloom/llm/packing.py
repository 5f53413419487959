"""Sequence packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most one sequence.  Pieces are dealt at
random over shards of about ``SHARD`` pieces, each of which is packed for
itself; what that costs against one packing of all is at most a part of one
sequence per shard.  In a shard a solution is a list of bins.  Crossover puts a
choice of the best-filled bins of one parent into the other, takes out the bins
that hold one of their pieces a second time, and best-fits the pieces displaced
by that.  Several islands breed the same shard in different tasks; after every
epoch each island hands its elite to the next one.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.pieces import PieceCache
from quantloom.llm.store import written
from quantloom.llm.text import chunks, mix, mix_int, raw_bytes, release

CAPACITY = 2048
SHARD = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
SEPARATOR = 0
CACHE_WORDS = 500_000
#: Islands share tasks beyond this number; it bounds scheduling, not work.
MAX_TASKS = 10_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"


class WordEncoder:
    """The ids of a word-level BPE tokenizer that lower-cases, drops white space and never joins what it parts.

    A text's ids are those of its stretches between white space, one after
    another, and most stretches are known already.  A new one that is letters
    with a tail of punctuation goes straight to the BPE model, letters and tail
    each for itself; anything else is left to the whole tokenizer, and so are
    texts with one of its added tokens.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t.lower().encode() for t in added]
        self.cache = PieceCache(self._encode_new, CACHE_WORDS)
        self.words: dict[bytes, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes | None:
        """The ids of letters that are in lower case, by the BPE model alone; None for anything else."""
        letters = word.decode()
        if not letters.isalpha():
            return None
        if not letters.isascii():
            if max(letters) >= "\u0180" or letters.lower() != letters:
                return None
            letters = "".join([_BYTE_LETTERS[b] for b in word])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _encode_new(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words, found = self.words, []
        if len(words) > CACHE_WORDS:
            words.clear()
        for stretch in stretches:
            word = stretch.rstrip(_TAIL)
            if word not in words:
                words[word] = self._word(word)
            ids = words[word]
            if ids is None:
                ids = self._whole(stretch.decode())
            elif len(word) < len(stretch):
                tail = stretch[len(word) :]
                if tail not in words:
                    words[tail] = self._whole(tail.decode())
                ids += words[tail]
            found.append(ids)
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), np.array([len(f) // 4 for f in found], np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of UTF-8 texts."""
        ids, counts = self.encode_flat(texts)
        return np.split(ids, np.cumsum(counts)[:-1])

    def encode_flat(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same end to end, and how many ids each text has."""
        chunk = b"\0".join(texts).lower()  # of bytes: A-Z only; no added token has a zero byte
        # Combining marks: composition depends on the case; added tokens: so does their single id.
        marks = [m for m in (b"\xcc", b"\xcd", *self.added) if m in chunk]
        whole = [k for k, t in enumerate(texts) if any(m in t.lower() for m in marks)] if marks else []
        left = set(whole)
        words = [t.lower().split() if k not in left else [] for k, t in enumerate(texts)]  # ASCII white space only
        ids, lengths = self.cache.lookup([w for own in words for w in own])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.diff(ends[np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])])
        if not whole:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in whole:
            parts[k] = np.frombuffer(self._whole(texts[k].decode()), "<u4").astype(np.int64)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


#: ASCII punctuation without the apostrophe, which begins contractions.
_TAIL = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)


def _byte_letters() -> list[str]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """One row per piece: its document, its place in it, the CRC-32 of its ids, and a random ``slot``.

    Every text is followed by one id ``SEPARATOR``, so null and empty texts are
    one piece of one id.  Texts longer than the capacity are cut at multiples
    of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        base, n = mix_int(TaskContext.get().partitionId() + 1), 0
        for part in chunks(batches):
            data, offsets = raw_bytes(part.column("text"))
            body = data.tobytes()
            ids, counts = own.encode_flat([body[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            ends = np.cumsum(counts + 1)  # a separator behind every text
            packed = np.full(ends[-1], SEPARATOR, "<u4")
            inside = np.ones(len(packed), bool)
            inside[ends - 1] = False
            packed[inside] = ids
            parts = -(-(counts + 1) // capacity)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first = np.repeat(ends - counts - 1, parts)
            start = nth * capacity
            length = np.minimum(capacity, np.repeat(counts + 1, parts) - start)
            view = memoryview(packed.tobytes())
            checks = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip((first + start).tolist(), (first + start + length).tolist())]
            slots = mix(np.uint64(base) + np.arange(n + 1, n + 1 + len(nth), dtype=np.uint64)) >> np.uint64(1)
            n += len(nth)
            columns = [part.column("doc_id").take(pa.array(np.repeat(np.arange(part.num_rows), parts))), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(checks, pa.int64()), pa.array(slots.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "slot"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


class Bins:
    """Open bins by the room they have left; ``put`` takes a fullest one that still fits.

    A bit of ``rooms`` is set for every room that some bin has left, so the
    least room of at least a size is the lowest bit above it.
    """

    def __init__(self, capacity: int, sizes: list[int]) -> None:
        self.capacity, self.sizes = capacity, sizes
        self.items: list[list[int]] = []
        self.having: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def _open(self, own: int, room: int) -> None:
        if room:
            self.having[room].append(own)
            self.rooms |= 1 << room

    def add(self, items: list[int]) -> None:
        self.items.append(items)
        self._open(len(self.items) - 1, self.capacity - sum(map(self.sizes.__getitem__, items)))

    def put(self, item: int) -> None:
        size = self.sizes[item]
        above = self.rooms >> size
        if not above:
            self.add([item])
            return
        room = size + (above & -above).bit_length() - 1
        own = self.having[room].pop()
        if not self.having[room]:
            self.rooms ^= 1 << room
        self.items[own].append(item)
        self._open(own, room - size)


def _best_fit(order: np.ndarray, sizes: np.ndarray, capacity: int, kept: list[list[int]] | None = None) -> list[list[int]]:
    bins = Bins(capacity, sizes.tolist())
    for items in kept or []:
        bins.add(list(items))
    for item in order.tolist():
        bins.put(item)
    return bins.items


def _fills(bins: list[list[int]], sizes: np.ndarray) -> np.ndarray:
    if not bins:
        return np.zeros(0, np.int64)
    counts = np.array([len(b) for b in bins])
    return np.add.reduceat(sizes[np.fromiter(chain.from_iterable(bins), np.int64)], np.cumsum(counts) - counts)


def fitness(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller full ones."""
    return len(bins), -float(((_fills(bins, sizes) / capacity) ** 2).sum())


def crossover(giver: list[list[int]], taker: list[list[int]], sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Injects whole well-filled bins of one parent and best-fits what they displace."""
    ranked = np.argsort(-_fills(giver, sizes), kind="stable")
    ranked = ranked[: max(1, int(len(ranked) * rng.uniform(0.3, 0.8)))]
    chosen = ranked[rng.random(len(ranked)) < 0.7]
    injected = [giver[i] for i in chosen.tolist()]
    taken = set(chain.from_iterable(injected))
    kept, displaced = [], []
    for items in taker:
        if taken.isdisjoint(items):
            kept.append(items)
        else:
            displaced += [i for i in items if i not in taken]
    # The emptiest bins are opened as well, so that their pieces may find room elsewhere.
    order = np.argsort(_fills(kept, sizes), kind="stable").tolist()
    opened = set(order[: max(1, len(kept) // 50)])
    for i in opened:
        displaced += kept[i]
    kept = [b for i, b in enumerate(kept) if i not in opened]
    loose = np.array(displaced, np.int64)
    loose = loose[np.argsort(-sizes[loose], kind="stable")] if len(loose) else loose
    return _best_fit(loose, sizes, capacity, injected + kept)


def _founders(sizes: np.ndarray, capacity: int, island: int, count: int, rng: np.random.Generator) -> list[list[list[int]]]:
    """Best fit in decreasing order, exactly and with disturbed sizes."""
    out = []
    for k in range(count):
        noise = rng.normal(0, capacity / 40 * (k + island), len(sizes)) if k + island else 0
        out.append(_best_fit(np.argsort(-(sizes + noise), kind="stable"), sizes, capacity))
    return out


def _bound(sizes: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by volume, and as two pieces over half a bin never share one."""
    return max(-(-int(sizes.sum()) // capacity), int((sizes > capacity // 2).sum()))


def _flat(bins: list[list[int]], n: int) -> bytes:
    out = np.empty(n, "<i4")
    for k, items in enumerate(bins):
        out[items] = k
    return out.tobytes()


def _lists(flat: bytes) -> list[list[int]]:
    own = np.frombuffer(flat, "<i4")
    order = np.argsort(own, kind="stable")
    return [p.tolist() for p in np.split(order, np.flatnonzero(np.diff(own[order])) + 1)] if len(own) else []


def breed(sizes: np.ndarray, population: list[list[list[int]]], capacity: int, rng: np.random.Generator, generations: int = GENERATIONS) -> list[list[list[int]]]:
    """Some generations of one island, fittest first; stops where no better packing can exist."""
    ranked = sorted(((fitness(b, sizes, capacity), k, b) for k, b in enumerate(population)), key=lambda r: r[:2])
    bound, born = _bound(sizes, capacity), len(ranked)
    for _ in range(generations):
        if not ranked or ranked[0][0][0] <= bound:
            break
        a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        giver, taker = sorted((int(a), int(b)))
        child = crossover(ranked[giver][2], ranked[taker][2], sizes, capacity, rng)
        ranked = sorted([*ranked, (fitness(child, sizes, capacity), born, child)], key=lambda r: r[:2])[:POPULATION]
        born += 1
    return [r[2] for r in ranked]


_STATE = "shard long, island int, sizes binary, population array<binary>"


def _evolve(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
                rng = np.random.default_rng([row["shard"], row["island"], epoch])
                found = [_lists(p) for p in row["population"]] or _founders(sizes, capacity, row["island"], POPULATION, rng)
                found = breed(sizes, found, capacity, rng)
                yield pa.RecordBatch.from_pylist([row | {"population": [_flat(b, len(sizes)) for b in found]}], batch.schema)

    return run


def _migrate(state: DataFrame, islands: int) -> DataFrame:
    """Every island keeps its population and gets the elite of the one before it."""
    elite = state.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.slice("population", 1, 1).alias("guests"))
    return state.join(elite, ["shard", "island"]).select("shard", "island", "sizes", F.concat("population", "guests").alias("population"))


def pack(table: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Gives every piece of a *written* table of pieces a ``sequence_id`` and an ``offset``.

    Sequences have no gaps and hold at most ``capacity`` ids.
    """
    n_shards = max(1, -(-table.count() // shard))
    dealt = table.withColumn("shard", F.pmod("slot", F.lit(n_shards)))

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(["length", "slot"], ascending=[False, True], kind="stable")
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "sizes": [ordered["length"].to_numpy("<i4").tobytes()]})

    start = dealt.select("shard", "length", "slot").groupBy("shard").applyInPandas(gather, "shard long, sizes binary")
    state = start.select("shard", F.explode(F.array(*map(F.lit, range(islands)))).alias("island"), "sizes", F.array().cast("array<binary>").alias("population"))
    tasks = min(MAX_TASKS, n_shards * islands)
    state = written(state.repartition(tasks, "shard", "island").mapInArrow(_evolve(capacity, 0), _STATE), "islands")
    for epoch in range(1, epochs):
        state = written(_migrate(state, islands).repartition(tasks, "shard", "island").mapInArrow(_evolve(capacity, epoch), _STATE), "islands")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts = [p[0] for p in batch.column("population").to_pylist()]
            n = [int(np.frombuffer(f, "<i4").max(initial=-1)) + 1 for f in firsts]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("island"), pa.array(n, pa.int32()), pa.array(firsts, pa.binary())], ["shard", "island", "n", "bins"])

    elites = state.mapInArrow(choose, "shard long, island int, n int, bins binary")
    winners = elites.groupBy("shard").agg(F.min_by("bins", F.struct("n", "island")).alias("bins"))

    def place(frame: pd.DataFrame, won: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(["length", "slot"], ascending=[False, True], kind="stable")
        ordered = ordered.assign(bin=np.frombuffer(won["bins"].iloc[0], "<i4").astype(np.int64)).sort_values("bin", kind="stable")
        before = ordered.groupby("bin")["length"].cumsum() - ordered["length"]
        return ordered.assign(sequence_id=ordered["shard"] * (1 << 24) + ordered["bin"], offset=before)[_OUT]

    placed = dealt.groupBy("shard").cogroup(winners.groupBy("shard")).applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed


_OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents (doc_id, text) in as few sequences of ``capacity`` ids as the islands find."""
    return pack(written(pieces(docs, tokenizer, capacity), "pieces"), capacity)
