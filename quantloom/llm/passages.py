"""Repeated passages by sparse suffix arrays.

A suffix is kept where its first ``GRAM`` words are the minimum of a window of
``WINDOW`` such runs, so equal passages keep suffixes at equal places: every
passage of ``LEAST`` words has one within its first ``WINDOW`` words, with at
least ``LEAST - WINDOW + 1`` words of the passage, the head, to its right.
Suffixes with a unique head are dropped; the others are sorted by the words
that follow and compared with those next to them.  Each is extended to the
right and to the left as far as another one has the same words; where both
together reach ``LEAST`` words, the passage is repeated.  Words are compared by
their 64-bit hashes, in contexts by 32 bits of each behind a head of 19 words;
the order is that of the hashes, which is as good as any other.

Sorted suffixes are compared in blocks.  Heads that a block's end cuts are
settled across blocks: each block offers the distinct passages of its cut heads
once, so a passage that stands in a third of all texts is a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm.store import written
from quantloom.llm.text import chunks, mix, tokenise, windowed

LEAST = 50
GRAM = 8
WINDOW = 32
HEAD = LEAST - WINDOW + 1
#: Words of context: a passage's end is met exactly by the last suffix with a whole head in it.
LEFT, RIGHT = WINDOW, LEAST

_NONE = np.uint32(0)


def minimisers(grams: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest run of every window, the rightmost of equals; ``bounds`` part the texts."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    # Equal runs are told apart by their place: the later one is smaller.
    views = np.lib.stride_tricks.sliding_window_view(grams[::-1], window)
    first = np.argmin(views, axis=1)
    at = (len(grams) - 1 - (np.arange(len(views)) + first))[::-1]
    begin = np.arange(len(at))
    owner = np.searchsorted(bounds, begin, "right") - 1
    inside = begin + window <= bounds[owner + 1]
    return np.unique(at[inside])


def _grams(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``width`` words that lie within one text, and where each text's runs begin."""
    runs = np.maximum(np.diff(bounds) - width + 1, 0)
    edges = np.concatenate([[0], np.cumsum(runs)])
    every = windowed(hashes, width)
    place = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], runs)
    return every[place], edges


def suffixes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, word, head): kept suffixes and the hash of their first ``HEAD`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            tokens = tokenise(part.column("text"))
            grams, edges = _grams(tokens.hashes, tokens.bounds, GRAM)
            kept = minimisers(grams, edges)
            owner = np.searchsorted(edges, kept, "right") - 1
            word = kept - edges[owner]
            at = tokens.bounds[owner] + word
            whole = at + HEAD <= tokens.bounds[owner + 1]
            owner, word, at = owner[whole], word[whole], at[whole]
            head = windowed(tokens.hashes, HEAD)[at] if len(at) else np.zeros(0, np.uint64)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(rows), part.column("text_key").take(rows), pa.array(word.astype(np.int32)), pa.array(head.view(np.int64))],
                ["doc_id", "text_key", "word", "head"],
            )

    return docs.mapInArrow(run, "doc_id long, text_key long, word int, head long")


def _contexts(texts: DataFrame) -> DataFrame:
    """The words to the right and, backwards, to the left of every candidate place, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            tokens = tokenise(part.column("text"))
            places = part.column("words")
            counts = np.diff(places.offsets.to_numpy())
            word = places.flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(part.num_rows), counts)
            low, high = tokens.bounds[owner], tokens.bounds[owner + 1]
            short = (tokens.hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # 0 is the end of a text
            at = low + word
            head = windowed(tokens.hashes, HEAD)[at] if len(at) else np.zeros(0, np.uint64)
            for a in range(0, len(at), 8192):
                piece = slice(a, a + 8192)
                right, left = _around(short, at[piece], low[piece], high[piece])
                rows = pa.array(owner[piece])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head[piece].view(np.int64)), right, left, part.column("doc_id").take(rows), part.column("text_key").take(rows), pa.array(word[piece].astype(np.int32))],
                    ["head", "right", "left", "doc_id", "text_key", "word"],
                )

    return texts.mapInArrow(run, "head long, right binary, left binary, doc_id long, text_key long, word int")


def _around(short: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[pa.Array, pa.Array]:
    def packed(places: np.ndarray, inside: np.ndarray) -> pa.Array:
        values = np.where(inside, short[np.clip(places, 0, max(len(short) - 1, 0))], _NONE).astype(">u4")
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(values.shape[1] * 4), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())

    ahead = at[:, None] + np.arange(HEAD, RIGHT)[None, :]
    behind = at[:, None] - np.arange(1, LEFT + 1)[None, :]
    return packed(ahead, ahead < high[:, None]), packed(behind, behind >= low[:, None])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(len(column), width).astype(np.uint64)


def _folded(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all beginnings of every row, the empty one first, and how many words there are before a text ends."""
    out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
    for k in range(words.shape[1]):
        out[:, k + 1] = mix(out[:, k] + words[:, k])
    ended = words == 0
    return out, np.where(ended.any(axis=1), np.argmax(ended, axis=1), words.shape[1])


_ORDER = ("head", "right", "left", "doc_id", "text_key", "word")
_NAMES = ("kind", "doc_id", "text_key", "first", "last", "other", "run", "n", "low", "high")
_COMPARED = "kind int, doc_id long, text_key long, first int, last int, other long, run long, n long, low long, high long"
_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
#: Kinds of rows: a settled stretch, a passage on offer to other blocks, a passage that asks for one.
STRETCH, OFFER, OPEN = 0, 1, 2
_NULL = np.iinfo(np.int64).min


def _rows(kind: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    have = {"kind": pa.array(np.full(size, kind, np.int32)), **columns}
    return pa.RecordBatch.from_arrays([have.get(c, pa.nulls(size, t)) for c, t in zip(_NAMES, _TYPES)], list(_NAMES))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Extends sorted suffixes over the words they share with others of the same block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        head = batch.column("head").to_numpy().view(np.uint64)
        ids = pc.fill_null(batch.column("doc_id"), _NULL).to_numpy()
        word = batch.column("word").to_numpy().astype(np.int64)
        ahead, room = _folded(_matrix(batch.column("right"), RIGHT - HEAD))
        behind, space = _folded(_matrix(batch.column("left"), LEFT))
        shift = np.arange(WINDOW)
        good = (space[:, None] >= shift) & (room[:, None] >= LEAST - HEAD - shift)
        row, by = np.nonzero(good)
        key = mix(mix(head[row] + ahead[row, LEAST - HEAD - by]) + behind[row, by] + by.astype(np.uint64))
        own, place, n = np.unique(key, return_inverse=True, return_counts=True)
        low, high = np.full(len(own), np.iinfo(np.int64).max), np.full(len(own), _NULL)
        np.minimum.at(low, place, ids[row])
        np.maximum.at(high, place, ids[row])
        twice = np.zeros(good.shape, bool)
        twice[row, by] = n[place] > 1
        partner = np.full(good.shape, _NULL)
        partner[row, by] = np.where(low[place] == ids[row], high[place], low[place])
        # Every stretch of shifts that another suffix shares is one stretch of words.
        padded = np.zeros((len(head), WINDOW + 2), np.int8)
        padded[:, 1:-1] = twice
        step = np.diff(padded, axis=1)
        at, near = np.nonzero(step == 1)
        far = np.nonzero(step == -1)[1] - 1
        other = partner[at, near]
        yield _rows(
            STRETCH, len(at), doc_id=batch.column("doc_id").take(pa.array(at)), text_key=batch.column("text_key").take(pa.array(at)),
            first=pa.array((word[at] - far).astype(np.int32)), last=pa.array((word[at] - near + LEAST).astype(np.int32)), other=pa.array(other, mask=other == _NULL),
        )
        cut = (head == head[0]) | (head == head[-1])
        offered = np.unique(place[cut[row]])
        yield _rows(OFFER, len(offered), run=pa.array(own[offered].view(np.int64)), n=pa.array(n[offered].astype(np.int64)), low=pa.array(low[offered], mask=low[offered] == _NULL), high=pa.array(high[offered], mask=high[offered] == _NULL))
        alone = np.flatnonzero(cut[row] & (n[place] == 1))
        at, by = row[alone], by[alone]
        yield _rows(
            OPEN, len(at), doc_id=batch.column("doc_id").take(pa.array(at)), text_key=batch.column("text_key").take(pa.array(at)),
            first=pa.array((word[at] - by).astype(np.int32)), last=pa.array((word[at] - by + LEAST).astype(np.int32)), run=pa.array(key[alone].view(np.int64)),
        )


def _with_places(keyed: DataFrame, places: DataFrame) -> DataFrame:
    """Texts with the list of their places (doc_id, text_key, word)."""
    lists = places.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("word")).alias("words")).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    return keyed.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("doc_id", "text_key", "text", "words")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, first_word, last_word, others): the maximal stretches of every text that are covered by
    passages of at least ``LEAST`` words which also stand elsewhere, in another text or in the same one.

    ``last_word`` is exclusive; ``others`` names ids that share a part of the
    stretch, some of them where there are many.  Rows that repeat an id and a text are
    repeats of each other.  Null and short texts have no passages.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull()).withColumn("text_key", F.xxhash64("text"))
    kept = written(suffixes(rows), "suffixes")
    # Written apart, so that a common head can be split in the join.
    shared = written(kept.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("head"), "heads")
    places = kept.join(shared, "head").select("doc_id", "text_key", "word")
    ordered = _contexts(_with_places(rows, places)).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    compared = written(ordered.select(*_ORDER).mapInArrow(_compare, _COMPARED), "compared")
    found = compared.where(F.col("kind") == STRETCH).select("doc_id", "text_key", F.col("first").alias("a"), F.col("last").alias("b"), "other")
    offers = compared.where(F.col("kind") == OFFER).groupBy("run").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).where("n > 1")
    asked = compared.where(F.col("kind") == OPEN).select("doc_id", "text_key", F.col("first").alias("a"), F.col("last").alias("b"), "run")
    partner = F.when(F.col("low") == F.col("doc_id"), F.col("high")).otherwise(F.col("low"))
    late = asked.join(offers, "run").select("doc_id", "text_key", "a", "b", partner.alias("other"))
    return _stretches(found.unionByName(late))


def _stretches(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of one text as one stretch."""
    listed = spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"), F.sort_array(F.collect_set("other")).alias("others"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, first, last = [], [], []
            for row, each in enumerate(batch.column("spans").to_pylist()):
                for span in each:
                    if owner and owner[-1] == row and span["a"] <= last[-1]:
                        last[-1] = max(last[-1], span["b"])
                    else:
                        owner.append(row)
                        first.append(span["a"])
                        last.append(span["b"])
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_key").take(rows), pa.array(first, pa.int32()), pa.array(last, pa.int32()), batch.column("others").take(rows)],
                ["doc_id", "text_key", "first_word", "last_word", "others"],
            )

    return listed.mapInArrow(merge, "doc_id long, text_key long, first_word int, last_word int, others array<long>")
