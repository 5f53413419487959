"""Alignment of the tokens of two tokenizers on the same bytes.

Both tokenize every text; a token's byte range follows from the bytes of its
id.  Each side's token starts are matched backwards with the other side's: the
last token that starts not later covers that start.  Two ranges overlap exactly
if one of them covers the start of the other, so both directions together are
all overlaps.  Ends that both sides share cut a text into groups.

No token of either side goes on beyond a blank that follows another character
than white space.  So both sides have an end there, and the tokens, links and
groups of a text are those of its words, cut at such blanks.  A worker aligns
each distinct word once and puts texts together from them.

How many documents hold a pair of ids linked is counted over the whole corpus.
Texts go through in blocks of a few megabytes, at least one text each.  A block
has every distinct pair once, with its number of documents; these rows are
added up by pair, and the sums sent back to the blocks that asked.  A frequent
pair is so many rows as there are blocks, and nothing of the corpus is
broadcast or gathered.

Texts that are null or empty, or that either tokenizer does not give back byte
by byte (such as those with U+2581, which stands for a blank in pieces), have no
tokens: zeros and empty strings.  Rows are documents, equal ids included.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.pieces import PieceCache, Vocabulary, spread
from quantloom.llm.store import written
from quantloom.llm.text import chunks, release

#: A worker holds about a hundred bytes for each byte of a block, besides its tokenizers, pieces and words.
BLOCK_BYTES = 2 << 20
#: A worker forgets its words between blocks as soon as they exceed one of these.
MAX_WORDS = 300_000
MAX_WORD_LINKS = 3_000_000
MAX_WORD_CHARACTERS = 16 << 20
#: The pattern of which it is known that a match ends before a blank behind anything but white space.
WORDWISE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Side:
    """One tokenizer: texts to pieces that never merge with their neighbours, pieces to ids, ids to bytes."""

    vocabulary: Vocabulary
    cache: PieceCache
    #: Whether no token goes on beyond a blank that follows another character than white space.
    wordwise: bool

    def pieces(self, line: str) -> list[str]:
        raise NotImplementedError

    def _lines(self, texts: list[str | None]) -> Iterator[list[str]]:
        """Texts that stand in one line are cut as they are alone; a text that ends in white space ends its line."""
        line: list[str] = []
        for t in texts:
            if t is not None:
                line.append(t)
                if not self.wordwise or not t or t[-1].isspace():
                    yield line
                    line = []
        if line:
            yield line

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each behind a blank, end to end, and how many each has; null has none."""
        cut, counts = [], []
        for line in self._lines(texts):
            pieces = self.pieces(" " + " ".join(line))
            if len(line) == 1:
                counts.append(len(pieces))
            else:
                places = np.cumsum([len(p) for p in pieces])
                counts += np.diff(np.searchsorted(places, np.cumsum([len(t) + 1 for t in line]), "right"), prepend=0).tolist()
            cut += pieces
        ids, lengths = self.cache.lookup(cut)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        own = np.zeros(len(texts), np.int64)
        own[[t is not None for t in texts]] = counts
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(own)])])


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for ids in lists for i in ids], np.int64), np.array([len(ids) for ids in lists], np.int64)


class ByteSide(_Side):
    """A byte-level BPE file; the text gets a blank in front.

    Its own first step cuts a text by ``pattern``, and what is cut goes to its
    model piece by piece, so the pieces can be kept.  Added tokens are looked
    for by the whole tokenizer only, so their strings are plain text here.
    """

    def __init__(self, path: str, pattern: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model, self.pattern, self.wordwise = tokenizer.model, regex.compile(pattern), pattern == WORDWISE
        letters = _byte_letters()
        self.letters = {b: c for c, b in letters.items()}
        added = {k: t.content.encode() for k, t in tokenizer.get_added_tokens_decoder().items()}
        size = tokenizer.get_vocab_size()
        self.vocabulary = Vocabulary([added[k] if k in added else bytes(letters[c] for c in tokenizer.id_to_token(k)) for k in range(size)])
        self.cache = PieceCache(self._ids)

    def pieces(self, line: str) -> list[str]:
        return self.pattern.findall(line)

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        mapped = [p.encode().decode("latin-1").translate(self.letters) for p in pieces]
        return _joined([[t.id for t in self.model.tokenize(m)] for m in mapped])


class PieceSide(_Side):
    """A sentence-piece BPE model, which puts a blank in front by itself.

    No entry of it continues beyond a blank that follows another character
    (checked when it is loaded), so blanks and what follows them are merged for
    themselves.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        parts = True
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            if self.model.is_byte(k):
                tokens.append(bytes([int(piece[3:-1], 16)]))
            else:
                tokens.append(piece.replace("▁", " ").encode())
                parts = parts and not re.search("[^▁]▁", piece)
        self.vocabulary = Vocabulary(tokens)
        self.blank = self.model.piece_to_id("▁")
        self.cut, self.wordwise = re.compile(" +[^ ]*" if parts else "(?s).+"), parts
        self.cache = PieceCache(self._ids, 1)  # its pieces are words, which are kept already

    def pieces(self, line: str) -> list[str]:
        return self.cut.findall(line)

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The model adds the first blank itself, but not to an empty text.
        return _joined([ids or [self.blank] for ids in self.model.encode([p[1:] for p in pieces], num_threads=1)])


@dataclass
class Spans:
    """Tokens of a batch: ``doc`` their text, ``start`` and ``end`` their bytes, counted through the batch."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ids: np.ndarray


def _spans(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> Spans:
    end = np.cumsum(vocabulary.lengths[ids])
    return Spans(np.repeat(np.arange(len(counts)), counts), end - vocabulary.lengths[ids], end, ids)


def _take(side: _Side, texts: list[str], good: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> Spans:
    kept = np.where(good, counts, 0)
    return _spans(ids[np.repeat(good, counts)], kept, side.vocabulary)


def tokens_of(a: _Side, b: _Side, texts: list[str]) -> tuple[Spans, Spans]:
    """Tokens of the texts, each behind a blank, that both sides give back byte by byte; the others have none."""
    good = np.array(["▁" not in t for t in texts], bool)
    wanted = [t if g else None for t, g in zip(texts, good.tolist())]
    raw = [b"" if t is None else (" " + t).encode() for t in wanted]
    found = []
    for side in (a, b):
        ids, counts = side.encode(wanted)
        data = side.vocabulary.decode(ids)
        ends = np.concatenate([[0], np.cumsum(counts)])
        sizes = np.concatenate([[0], np.cumsum(side.vocabulary.lengths[ids])])[ends]
        if data != b"".join(raw) or (np.diff(sizes) != [len(r) for r in raw]).any():
            good &= np.array([data[x:y] == r for x, y, r in zip(sizes[:-1].tolist(), sizes[1:].tolist(), raw)], bool)
        found.append((ids, counts))
    return tuple(_take(side, texts, good, ids, counts) for side, (ids, counts) in zip((a, b), found))


def links(a: Spans, b: Spans) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of token places (in a, in b) whose bytes overlap; both sides have the same bytes of every text."""
    cover_b = np.searchsorted(b.start, a.start, "right") - 1
    cover_a = np.searchsorted(a.start, b.start, "right") - 1
    later = np.flatnonzero(b.start > a.start[cover_a])  # equal starts are found already
    return np.concatenate([np.arange(len(a.ids)), cover_a[later]]), np.concatenate([cover_b, later])


def _groups(a: Spans, b: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every token of both sides, and the text of every group; ends that both share close a group."""
    ends = np.zeros((2, int(a.end[-1]) + 1 if len(a.end) else 1), bool)
    ends[0, a.end] = ends[1, b.end] = True
    shared_a, shared_b = ends[1, a.end], ends[0, b.end]
    return np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b, b.doc[shared_b]


class _Numbers:
    """Decimal ids with the mark behind them."""

    def __init__(self, size: int, marks: str) -> None:
        self.marks = {m: k for k, m in enumerate(marks)}
        self.texts = [f"{k}{m}" for k in range(size) for m in marks]

    def __call__(self, ids: np.ndarray, last: np.ndarray, inner: str, outer: str) -> np.ndarray:
        return ids * len(self.marks) + np.where(last, self.marks[outer], self.marks[inner])


@lru_cache(maxsize=1)
def _numbers(size: int) -> _Numbers:
    return _Numbers(size, ",|;")


def group_texts(a: Spans, b: Spans, n_docs: int) -> tuple[list[str], np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every text, and its number of groups."""
    group_a, group_b, owner = _groups(a, b)
    n = len(owner)
    size_a, size_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    begin = np.cumsum(size_a + size_b) - size_a - size_b
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    last_a, last_b = np.diff(group_a, append=n) > 0, np.diff(group_b, append=n) > 0
    numbers = _numbers(int(max(a.ids.max(initial=0), b.ids.max(initial=0), 1 << 16)) + 1)
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    codes[begin[group_a] + np.arange(len(a.ids)) - first_a[group_a]] = numbers(a.ids, last_a, ",", "|")
    codes[begin[group_b] + size_a[group_b] + np.arange(len(b.ids)) - first_b[group_b]] = numbers(b.ids, last_b, ",", ";")
    words = list(map(numbers.texts.__getitem__, codes.tolist()))
    per_doc = np.bincount(a.doc, minlength=n_docs) + np.bincount(b.doc, minlength=n_docs)
    ends = np.cumsum(per_doc)
    texts = ["".join(words[x:y])[:-1] for x, y in zip((ends - per_doc).tolist(), ends.tolist())]
    return texts, np.bincount(owner, minlength=n_docs)


class Words:
    """The alignments of the distinct words of a worker.

    ``known`` numbers them.  ``sizes`` has their tokens on both sides, groups
    and links, ``pairs`` the ids of all links, end to end, ``texts`` the groups.
    """

    def __init__(self, a: _Side, b: _Side) -> None:
        self.sides = a, b
        self.cut = re.compile(r" (?<=\S )") if a.wordwise and b.wordwise else None
        self._empty()

    def _empty(self) -> None:
        self.known: dict[str, int] = {}
        self.characters, self.texts = 0, []
        self.sizes, self.good = np.zeros((4, 0), np.int64), np.zeros(0, bool)
        self.pairs, self.begins = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _add(self, new: list[str]) -> None:
        a, b = tokens_of(*self.sides, new)
        one, two = links(a, b)
        doc = a.doc[one]
        order = np.argsort(doc, kind="stable")
        texts, n_groups = group_texts(a, b, len(new))
        sizes = np.array([np.bincount(a.doc, minlength=len(new)), np.bincount(b.doc, minlength=len(new)), n_groups, np.bincount(doc, minlength=len(new))])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.characters += sum(map(len, new))
        self.texts += texts
        self.sizes, self.good = np.concatenate([self.sizes, sizes], axis=1), np.concatenate([self.good, sizes[0] > 0])
        self.pairs = np.concatenate([self.pairs, (a.ids[one] << 32 | b.ids[two])[order]])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes[3])])

    def _numbers(self, words: list[str]) -> np.ndarray:
        own = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(own < 0).tolist()
        if missing:
            self._add(list(dict.fromkeys(words[k] for k in missing)))
            own[missing] = [self.known[words[k]] for k in missing]
        return own

    def lookup(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts, end to end, and how many each has; null and empty ones have none."""
        if len(self.known) > MAX_WORDS or len(self.pairs) > MAX_WORD_LINKS or self.characters > MAX_WORD_CHARACTERS:
            self._empty()
        cut = [[] if not t else self.cut.split(t) if self.cut else [t] for t in texts]
        counts = np.array([len(words) for words in cut], np.int64)
        own = self._numbers([w for words in cut for w in words])
        bad = np.unique(np.repeat(np.arange(len(texts)), counts)[~self.good[own]]).tolist()
        if bad:  # such a text is one word: it counts whether it comes back as a whole
            for k in bad:
                cut[k] = [texts[k]]
            counts[bad] = 1
            own = self._numbers([w for words in cut for w in words])
        return own, counts


@lru_cache(maxsize=2)
def words_of(byte_path: str, pattern: str, piece_path: str) -> Words:
    return Words(ByteSide(byte_path, pattern), PieceSide(piece_path))


#: Rows of texts have ``pairs`` and ``times``: the numbers of their pairs within the block and how often
#: each is linked (32-bit integers).  Rows of pairs have a number, ``nth``, and the texts of the block that hold them.
_ROWS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary, a int, b int, nth int, docs long"
_TEXT_COLUMNS = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
_PAIR_COLUMNS = ["block", "a", "b", "nth", "docs"]


def _block(block: int, part: pa.RecordBatch, words: Words, digest: bool) -> Iterator[dict]:
    n = part.num_rows
    own, counts = words.lookup(part.column("text").to_pylist())
    bounds = np.concatenate([[0], np.cumsum(counts)])
    sizes = np.diff(np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(words.sizes[:, own], axis=1)], axis=1)[:, bounds], axis=1)
    nth, codes = pd.factorize(words.pairs[spread(words.begins[own], words.sizes[3, own])])
    held, times = np.unique(np.repeat(np.arange(n), sizes[3]) * max(1, len(codes)) + nth, return_counts=True)
    doc, pair = held // max(1, len(codes)), held % max(1, len(codes))
    cuts = 4 * np.searchsorted(doc, np.arange(n + 1))
    packed = [p.astype("<i4").tobytes() for p in (pair, times)]
    groups = list(map(words.texts.__getitem__, own.tolist()))
    texts = [";".join(groups[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    if digest:
        texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
    yield {
        "block": np.full(n, block), "doc_id": part.column("doc_id"), "n_a": sizes[0], "n_b": sizes[1], "n_groups": sizes[2], "n_links": sizes[3], "groups": texts,
        "pairs": [packed[0][x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())], "times": [packed[1][x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())],
    }
    yield {
        "block": np.full(len(codes), block), "a": (codes >> 32).astype(np.int32), "b": (codes & 0xFFFFFFFF).astype(np.int32),
        "nth": np.arange(len(codes), dtype=np.int32), "docs": np.bincount(pair, minlength=len(codes)),
    }


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in _ROWS.split(", "))])


def aligned(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, digest: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of texts and rows of pairs of all blocks; see ``_ROWS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words_of(byte_path, pattern, piece_path)
        block = TaskContext.get().partitionId() << 32
        for part in chunks(batches, size=block_bytes):
            for columns in _block(block, part, own, digest):
                size = len(columns["block"])
                arrays = [columns[f.name].cast(f.type) if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _SCHEMA]
                yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)
            columns = arrays = None
            release()  # after each block: tasks of one executor would else keep the peaks of all
            block += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best): the documents that hold a pair linked, and whether no pair of the same ``a`` has more.

    An ``a`` has at most as many pairs as the other side has ids.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def _answer(_, texts: pa.Table, answers: pa.Table) -> pa.Table:
    n = texts.num_rows
    count, best = np.zeros(answers.num_rows, np.int64), np.zeros(answers.num_rows, np.int64)
    nth = answers["nth"].to_numpy()
    count[nth], best[nth] = answers["count"].to_numpy(), answers["best"].to_numpy(zero_copy_only=False)
    cells = [np.frombuffer(b"".join(texts[c].to_pylist()), "<i4").astype(np.int64) for c in ("pairs", "times")]
    ends = np.cumsum([len(p) // 4 for p in texts["pairs"].to_pylist()], dtype=np.int64)
    out = texts.select(_TEXT_COLUMNS[1:7])
    for name, values in (("n_best", best), ("count_sum", count)):
        sums = np.concatenate([[0], np.cumsum(values[cells[0]] * cells[1])])
        out = out.append_column(name, pa.array(np.diff(np.concatenate([[0], sums[ends]])) if n else [], pa.int64()))
    return out


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, digest: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum of every row of (doc_id, text).

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or with ``digest`` its SHA-256.
    ``count_sum`` adds the counts of all links, ``n_best`` counts the links
    whose count is the highest of their ``a``.
    """
    rows = written(aligned(docs, byte_path, pattern, piece_path, digest, block_bytes), "aligned")
    pairs = rows.where(F.col("nth").isNotNull()).select(_PAIR_COLUMNS)
    answers = pairs.join(pair_counts(pairs), ["a", "b"]).select("block", "nth", "count", "best")
    texts = rows.where(F.col("nth").isNull()).select(F.col("block").alias("text_block"), *_TEXT_COLUMNS[1:])
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return texts.groupBy("text_block").cogroup(answers.groupBy("block")).applyInArrow(_answer, schema)
