"""Ranked lexical search without a document index: one Aho-Corasick scan of all texts.

The terms of all items become one automaton.  Every term is guarded by a blank
on both sides, and texts are brought into that form (A-Z lower-cased, whatever
is no term character one blank), so that each match is a whole term; matches
may share the blank between them.  The scan gives every document's length and
the frequencies of the terms that any item asks for.  Document frequencies and
corpus totals are sums over these small rows; scores are added up per task, for
a few documents and all items at a time, and only the best rows of each task
leave it.

Items are worked off in blocks of about ``BLOCK_TERMS`` (item, term) pairs, an
item never being divided: automaton, weights and the table from terms to items
are broadcast per block and do not grow with the documents or the number of
items.

Rows of one item id are one item with the terms of all of them, a null id
included.  Documents are rows: equal ids rank each for itself, null ids behind
all others of equal score, texts without a term (null and empty ones too) are
no documents.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.store import written
from quantloom.llm.text import ALNUM, LOWER, chunks, raw_bytes, release

TOP = 10
BLOCK_TERMS = 200_000
#: Scores held at a time in a task, as documents times items.
CELLS = 1 << 22
#: Best rows of an item are thinned out in so many groups of tasks before they meet.
GROUPS = 64

UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Every byte as itself, lower-cased, or a blank.
_GUARDED = np.where(ALNUM, LOWER, 32).astype(np.uint8)

_COUNTS = "doc_id long, n long, terms binary, counts binary"


def item_terms(items: DataFrame, ident: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term), once each."""
    found = F.regexp_extract_all(F.translate(text, UPPER_CASE, LOWER_CASE), F.lit(f"({TERM})"), F.lit(1))
    return items.select(F.col(ident).cast("long").alias("item"), F.explode(found).alias("term")).distinct()


@lru_cache(maxsize=1)
def _automaton(key: str, terms: Broadcast) -> ahocorasick.Automaton:
    """One character per byte, so that bytes of several-byte characters are ordinary ones."""
    out = ahocorasick.Automaton()
    for k, term in enumerate(terms.value):
        out.add_word(f" {term} ".encode().decode("latin-1"), k)
    out.make_automaton()
    return out


def scan(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of every text with a term: its length, the numbers of its known terms, how often each occurs.

    ``terms`` and ``counts`` are little-endian 32-bit integers.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(terms), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared) if terms else None
        for part in chunks(batches):
            data, offsets = raw_bytes(part.column("text"))
            plain = _GUARDED[data]
            inside = plain != 32
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            begins = offsets[:-1][offsets[:-1] < len(data)]
            first[begins] = inside[begins]
            lengths = np.diff(np.concatenate([[0], np.cumsum(first)])[offsets])
            found = [np.zeros(0, np.int64)] * part.num_rows
            if automaton is not None:
                for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    if lengths[k]:
                        found[k] = np.fromiter(map(itemgetter(1), automaton.iter(f" {plain[a:b].tobytes().decode('latin-1')} ")), np.int64)
            hits = np.array([len(f) for f in found], np.int64)
            codes, counts = np.unique(np.repeat(np.arange(part.num_rows), hits) << 32 | np.concatenate(found), return_counts=True)
            cuts = 4 * np.searchsorted(codes >> 32, np.arange(part.num_rows + 1))
            kept = np.flatnonzero(lengths)
            packed = [(codes & 0xFFFFFFFF).astype("<i4").tobytes(), counts.astype("<i4").tobytes()]
            columns = [pa.array([p[cuts[k] : cuts[k + 1]] for k in kept.tolist()], pa.binary()) for p in packed]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(kept)), pa.array(lengths[kept], pa.int64()), *columns], ["doc_id", "n", "terms", "counts"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _COUNTS)


def document_frequencies(counts: DataFrame, size: int) -> dict[int, int]:
    """How many rows hold each of ``size`` terms; added up per task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4"), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["term", "df"])

    sums = counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return dict(map(tuple, sums.collect()))


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Best:
    """The best ``top`` documents of every item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, top: int) -> None:
        self.items, self.top = items, top
        self.item, self.null, self.doc, self.score = (np.zeros(0, t) for t in (np.int64, bool, np.int64, np.int64))
        self.least = np.ones(items, np.int64)

    def add(self, null: np.ndarray, doc: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per document and a column per item."""
        least = self.least
        if len(scores) > self.top:  # equal scores at the edge all stay until ids decide
            least = np.maximum(least, np.partition(scores, len(scores) - self.top, axis=0)[len(scores) - self.top])
        row, item = np.nonzero(scores >= least)
        joined = [np.concatenate(p) for p in ((self.item, item), (self.null, null[row]), (self.doc, doc[row]), (self.score, scores[row, item]))]
        order = np.lexsort((joined[2], joined[1], -joined[3], joined[0]))
        item = joined[0][order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[nth < self.top]
        self.item, self.null, self.doc, self.score = (p[keep] for p in joined)
        last = np.flatnonzero(nth[nth < self.top] == self.top - 1)
        self.least = np.ones(self.items, np.int64)
        self.least[self.item[last]] = self.score[last]


def _add_up(rows: np.ndarray, items: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sums of whole numbers per (row, item), exact in 64 bits."""
    cells = rows * shape[1] + items
    if values.sum(dtype=float) < 2**52:  # doubles hold every such sum exactly
        return np.bincount(cells, values, shape[0] * shape[1]).astype(np.int64).reshape(shape)
    out = np.zeros(shape[0] * shape[1], np.int64)
    np.add.at(out, cells, values)
    return out.reshape(shape)


def best_documents(counts: DataFrame, owners: list[list[int]], weights: list[int], n_items: int, documents: int, length: int, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): the best rows of each task, ``item`` by its number.

    ``owners`` has the items of every term.
    """
    sizes = np.array([len(o) for o in owners], np.int64)
    tables = (sizes, np.cumsum(sizes) - sizes, np.array([i for o in owners for i in o], np.int64), np.array(weights, np.int64))
    shared = counts.sparkSession.sparkContext.broadcast(tables)
    step = max(1, CELLS // max(1, n_items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_owners, first_owner, owner, w = shared.value
        best = Best(n_items, top)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                terms, tf = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("terms", "counts"))
                known = np.array([len(t) // 4 for t in batch.column("terms").to_pylist()], np.int64)
                row = np.repeat(np.arange(batch.num_rows), known)
                n = batch.column("n").to_numpy(zero_copy_only=False)
                m = 10 + (90 * n * documents) // length
                value = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                ends = np.cumsum(n_owners[terms])
                total, cut = np.zeros((batch.num_rows, n_items), np.int64), 0
                while cut < len(terms):  # a term may belong to many items: so many pairs at a time
                    to = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + CELLS, "right")))
                    t = terms[cut:to]
                    many = n_owners[t]
                    position = np.arange(many.sum()) + np.repeat(first_owner[t] - (np.cumsum(many) - many), many)
                    total += _add_up(np.repeat(row[cut:to], many), owner[position], np.repeat(value[cut:to], many), total.shape)
                    cut = to
                ids = batch.column("doc_id")
                best.add(ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False), total)
        group = np.full(len(best.item), TaskContext.get().partitionId() % GROUPS, np.int32)
        columns = [pa.array(best.item), pa.array(group), pa.array(best.doc, mask=best.null), pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "group", "doc_id", "score"])

    return counts.mapInArrow(run, "item long, group int, doc_id long, score long")


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of each item (item_id, text).

    A score sums ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over the
    item's terms, with ``w`` the term's weight and ``m`` the document's length
    against the mean; see ``weight``.  Rows without a score above 0 are none.
    """
    spark = docs.sparkSession
    asked = written(item_terms(items), "terms")
    blocks = max(1, -(-asked.count() // block_terms))
    out = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        names = sorted({r["item"] for r in rows}, key=lambda i: (i is None, i))
        number = {name: k for k, name in enumerate(names)}
        owners: dict[str, list[int]] = {}
        for r in rows:
            owners.setdefault(r["term"], []).append(number[r["item"]])
        terms = sorted(owners)
        counts = written(scan(docs, terms), "counts")
        total = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        if not total["documents"] or not terms:
            continue
        frequency = document_frequencies(counts, len(terms))
        weights = [weight(total["documents"], frequency.get(k, 0)) for k in range(len(terms))]
        found = best_documents(counts, [owners[t] for t in terms], weights, len(names), *total, top)
        found = _ranked(found, "item", "group").where(F.col("rank") <= top).drop("rank")
        found = _ranked(found, "item").where(F.col("rank") <= top)
        ids = spark.createDataFrame(list(enumerate(names)), "item long, item_id long")
        out.append(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    joined = out[0]
    for more in out[1:]:
        joined = joined.unionByName(more)
    return joined


_LOWERED = f"""translate(coalesce("text", ''), '{UPPER_CASE}', '{LOWER_CASE}')"""
_CLASS = r"[a-z0-9\x{80}-\x{10FFFF}]+"

ORACLE = f"""
with docs as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOWERED}, '{_CLASS}') as w from documents),
lengths as (select rid, doc_id, len(w)::bigint as n from docs where len(w) > 0),
totals as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from lengths),
wanted as (select distinct item_id, unnest(regexp_extract_all({_LOWERED}, '{_CLASS}')) as term from benchmark),
counts as (
    select rid, term, count(*)::bigint as tf from (select rid, unnest(w) as term from docs)
    where term in (select term from wanted) group by rid, term),
weights as (
    select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as weight
    from counts, totals group by term),
scores as (
    select item_id, rid, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint as score
    from counts join weights using (term) join lengths using (rid) join wanted using (term), totals
    group by item_id, rid, doc_id)
select item_id, rank::integer as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
where rank <= {TOP}
"""
