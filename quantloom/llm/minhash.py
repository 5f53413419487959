"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is the set of its distinct runs of five words, each of weight 1, so that
candidates are found by the very similarity they are verified by.  Every element sends out the points of a Poisson process
whose rate is its weight, each to another of ``REGISTERS`` registers; a register
keeps the element that arrived first.  An element stops as soon as its next
point comes later than the last arrival of all registers, so long texts cost
little more than one point per element.  Registers of two texts agree with the
probability Jaccard similarity of their sets.

Texts with the same words are one node from the start.  Nodes that agree in a
band of registers are candidates.  Within a bucket each node is paired with the
bucket's leader and its neighbour, in small buckets with all others; pairs are
verified on the whole texts (plain Jaccard similarity of the distinct runs).
That settles most classes.  What is left in larger buckets is joined exactly:
of two sets of similarity 0.8 the rarest fifths, in one order for all, share a
run, so nodes of different classes that share such a run are verified too, and
no two similar nodes of a larger bucket are left in different classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm.components import components
from quantloom.llm.store import written
from quantloom.llm.text import CHUNK_BYTES, Tokens, chunks, mix, tokenise, windowed

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
REGISTERS = 127
SMALL_BUCKET = 8
#: Counters of how common a run is; they only order runs, so sharing one costs time, not links.
SLOTS = 1 << 20
#: Nodes of one run that a task compares with as many others.
BLOCK = 1024

_UNIT = 2.0**-53


def shingles(tokens: Tokens, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, element, count) of the distinct word runs of every text; a shorter text is one run."""
    counts = tokens.counts
    runs = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), runs)
    values = np.zeros(len(owner), np.uint64)
    full = windowed(tokens.hashes, width)
    begins = np.repeat(tokens.bounds[:-1] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(len(owner))
    long_enough = counts[owner] >= width
    values[long_enough] = full[begins[long_enough]]
    for row in np.flatnonzero((counts > 0) & (counts < width)):
        own = tokens.hashes[tokens.bounds[row] : tokens.bounds[row + 1]]
        values[owner == row] = windowed(own, len(own))
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], values[at], np.diff(np.append(at, len(owner)))


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """The first element to arrive in each register, ``texts`` rows of ``REGISTERS``."""
    m = REGISTERS
    arrival, winner = np.full(texts * m, np.inf), np.zeros(texts * m, np.uint64)
    time = np.zeros(len(elements))
    step = (mix(elements ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m - 1)).astype(np.int64) + 1
    register = (mix(elements ^ np.uint64(0x14057B7EF767814F)) % np.uint64(m)).astype(np.int64)
    for nth in range(m):  # a step coprime to a prime number of registers meets each of them once
        draw = (mix(elements + np.uint64((nth + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(float) * _UNIT
        time = time - np.log1p(-draw) * m / (weights * (m - nth))
        at = owner * m + register
        np.minimum.at(arrival, at, time)
        won = arrival[at] == time
        winner[at[won]] = elements[won]
        alive = time < arrival.reshape(texts, m).max(axis=1)[owner]
        if not alive.any():
            break
        owner, elements, weights, time, step = owner[alive], elements[alive], weights[alive], time[alive], step[alive]
        register = (register[alive] + step) % m
    return winner.reshape(texts, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    out = np.zeros((len(signature), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(signature), band + 1, np.uint64)
        for row in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, band * ROWS + row])
        out[:, band] = key
    return out


def _content(tokens: Tokens) -> list[bytes]:
    """128 bits of each text's word sequence."""
    salted = mix(tokens.hashes ^ np.uint64(0xD6E8FEB86659FD93))
    out = []
    for a, b in zip(tokens.bounds[:-1].tolist(), tokens.bounds[1:].tolist()):
        if a == b:
            out.append(b"")
            continue
        n = b - a
        weights = mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) | np.uint64(1)
        with np.errstate(over="ignore"):
            parts = mix(np.array([(tokens.hashes[a:b] * weights).sum(), (salted[a:b] * weights).sum()], np.uint64) + np.uint64(n))
        out.append(parts.tobytes())
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_key, content, n, bands) of every row; no bands and an empty content without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, size=2 * CHUNK_BYTES):
            tokens = tokenise(part.column("text"))
            owner, elements, _ = shingles(tokens)
            keys = band_keys(signatures(owner, elements, np.ones(len(elements)), part.num_rows)).view(np.int64)
            n = np.bincount(owner, minlength=part.num_rows)
            bands = [row.tolist() if some else None for row, some in zip(keys, n)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(_content(tokens), pa.binary()), pa.array(n.astype(np.int64)), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "content", "n", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, content binary, n long, bands array<long>")


def _pairs(buckets: DataFrame, turn: int) -> DataFrame:
    """Candidate pairs (a, b), a < b, of the ``turn``-th round from (key, node, n, next, size)."""
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), F.col("node").alias("node"), F.col("n").alias("n"))
    leaders = written(buckets.groupBy("key").agg(F.min(rank).alias("leader")), "leaders")
    starred = buckets.join(leaders, "key").select("node", "n", F.col("leader.node").alias("other"), F.col("leader.n").alias("m"))
    close = F.least("n", "m") >= THRESHOLD * F.greatest("n", "m")
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    stars = starred.where((F.col("node") != F.col("other")) & close).select(*ordered("node", "other"))
    # Buckets beyond a few thousand nodes are dealt over several tasks.
    salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("size") / 4096)).cast("int")
    dealt = buckets.where("size > 2").withColumn("salt", salt).repartition("key", "salt").sortWithinPartitions("key", "salt", F.xxhash64("next", F.lit(turn)), "node")

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            a, b = [], []
            for key, salt_, node, n, size in zip(*(batch.column(c).to_pylist() for c in ("key", "salt", "node", "n", "size"))):
                if last != (key, salt_):
                    last, held = (key, salt_), []
                for other, m in held:
                    if min(n, m) >= THRESHOLD * max(n, m):
                        a.append(min(node, other))
                        b.append(max(node, other))
                held = [*held, (node, n)] if size <= SMALL_BUCKET else [(node, n)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return stars.unionByName(dealt.select("key", "salt", "node", "n", "size").mapInArrow(neighbours, "a long, b long")).distinct()


def _slots(elements: np.ndarray) -> np.ndarray:
    return (elements & np.uint64(SLOTS - 1)).astype(np.int64)


def _commonness(texts: DataFrame) -> np.ndarray:
    """By slot, the number of runs of all texts beyond a small bucket's; 0 for rare ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for part in chunks(batches):
            total += np.bincount(_slots(shingles(tokenise(part.column("text")))[1]), minlength=SLOTS)
        at = np.flatnonzero(total)
        for a in range(0, len(at), 65536):
            piece = at[a : a + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(total[piece])], ["slot", "n"])

    found = texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > SMALL_BUCKET).toPandas()
    out = np.zeros(SLOTS, np.int64)
    out[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many first runs of a set of ``n`` meet those of every similar set."""
    return n - np.ceil(THRESHOLD * n - 1e-9).astype(np.int64) + 1


def _prefixes(texts: DataFrame) -> DataFrame:
    """(element, place, n, node, root): the rarest runs of every text and their places in its order."""
    shared = texts.sparkSession.sparkContext.broadcast(_commonness(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            owner, elements, _ = shingles(tokenise(part.column("text")))
            order = np.lexsort((elements, shared.value[_slots(elements)], owner))
            n = np.bincount(owner, minlength=part.num_rows)
            place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            kept = place < prefix_size(n)[owner]
            rows = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements[order][kept].view(np.int64)), pa.array(place[kept]), pa.array(n[owner[kept]]), part.column("node").take(rows), part.column("root").take(rows)],
                ["element", "place", "n", "node", "root"],
            )

    return texts.mapInArrow(run, "element long, place long, n long, node long, root long")


def _exact_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of nodes of different roots, among them all similar ones, from (node, text, root)."""
    runs = written(_prefixes(texts), "prefixes")
    mixed = written(runs.groupBy("element").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("element", "size"), "mixed-runs")
    rows = runs.join(mixed, "element").withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    # Every block of a run's nodes meets itself and every other one in a group of its own.
    names = ("place", "n", "node", "root")
    side = lambda mark, low, high: rows.select("element", low.alias("low"), high.alias("high"), *(F.col(c).alias(f"{mark}_{c}") for c in names))
    one = side("a", F.col("block"), F.explode(F.sequence("block", F.col("blocks") - 1)))
    two = side("b", F.explode(F.sequence(F.lit(0).cast("long"), "block")), F.col("block"))
    fresh = (F.col("a_root") != F.col("b_root")) & ((F.col("low") < F.col("high")) | (F.col("a_node") < F.col("b_node")))
    close = F.least("a_n", "b_n") >= THRESHOLD * F.greatest("a_n", "b_n")
    # The first run that two sets share leaves them at most the shorter rest in common.
    rest = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    enough = rest * (1 + THRESHOLD) + 1e-6 >= THRESHOLD * (F.col("a_n") + F.col("b_n"))
    pairs = one.join(two, ["element", "low", "high"]).where(fresh & close & enough)
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def similarity(first: np.ndarray, second: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(first, second, assume_unique=True))
    return both / (len(first) + len(second) - both) if len(first) or len(second) else 0.0


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similar) of the pairs, compared on their whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = []
                for name in ("first", "second"):
                    own, place = np.unique(part.column(name[0:1] + "_node").to_numpy(), return_index=True)
                    tokens = tokenise(part.column(name).take(pa.array(place)))
                    owner, elements, _ = shingles(tokens)
                    cuts = np.searchsorted(owner, np.arange(len(own) + 1))
                    sets.append({node: elements[cuts[i] : cuts[i + 1]] for i, node in enumerate(own.tolist())})
                a, b = part.column("f_node"), part.column("s_node")
                same = [similarity(sets[0][x], sets[1][y]) >= THRESHOLD for x, y in zip(a.to_pylist(), b.to_pylist())]
                yield pa.RecordBatch.from_arrays([a, b, pa.array(same)], ["a", "b", "similar"])

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("first"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("second"))
    rows = pairs.join(first, "a").join(second, "b").select(F.col("a").alias("f_node"), F.col("b").alias("s_node"), "first", "second")
    return rows.mapInArrow(compare, "a long, b long, similar boolean")


def _texts(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(node, text) of the wanted nodes; the content decides where an id is not unique."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            real = [x == y for x, y in zip(_content(tokenise(part.column("text"))), part.column("content").to_pylist())]
            yield part.filter(pa.array(real, pa.bool_())).select(["node", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("text"))
    joined = rows.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")))
    return joined.select("node", "content", "text").mapInArrow(same, "node long, text string").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key, class_id, class_size and ``keep``.

    ``class_id`` is the smallest doc_id of the class, ``class_size`` its number
    of rows, and ``keep`` marks the one text (doc_id, text_key) that stands for
    it; exact repeats of that row are marked too.  Null texts and texts without
    words are classes of their own.
    """
    spark = docs.sparkSession
    prints = written(fingerprints(docs, text), "fingerprints")
    named = prints.where("n > 0").groupBy("content").agg(F.min(F.struct("doc_id", "text_key")).alias("who"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = written(named.select(F.monotonically_increasing_id().alias("node"), "content", "who", "rows", "n", "bands"), "nodes")
    spread = nodes.select("node", "n", "bands", F.posexplode("bands").alias("band", "key"))
    spread = spread.select("node", "n", "key", F.get("bands", (F.col("band") + 1) % BANDS).alias("next"))
    # Written apart, so that a full bucket can be split in the join.
    sizes = written(spread.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bucket-sizes")
    buckets = written(spread.join(sizes, "key"), "buckets")
    wanted = nodes.select("node", "content", "who.*").join(buckets.select("node").distinct(), "node", "left_semi")
    texts = written(_texts(docs, wanted, text), "candidate-texts")
    tested, labels = None, None

    def settle(pairs: DataFrame) -> None:
        """Verifies the pairs that are still in different classes and joins the classes of the similar ones."""
        nonlocal tested, labels
        if labels is not None:
            side = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
            pairs = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
            pairs = pairs.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        fresh = written(_verified(pairs, texts), "compared")
        tested = fresh if tested is None else tested.unionByName(fresh)
        if fresh.where("similar").count():
            labels = components(written(tested.where("similar").select("a", "b"), "links"))

    # First only the pair with the foremost partner: it settles large groups at once.
    foremost = lambda pairs: pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    settle(foremost(_pairs(buckets, 0)))
    settle(_pairs(buckets, 1))
    crowded = buckets.where(F.col("size") > SMALL_BUCKET).select("node").distinct()
    if not crowded.isEmpty():
        inside = texts.join(crowded, "node", "left_semi")
        rooted = inside.withColumn("root", F.col("node")) if labels is None else inside.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = written(_exact_pairs(written(rooted, "crowded-texts")), "rest")
        settle(foremost(rest))
        settle(rest)
    if labels is None:
        labels = spark.createDataFrame([], "node long, root long")
    rooted = nodes.join(labels, "node", "left").select("node", "content", "who", "rows", F.coalesce("root", "node").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("who").alias("first"), F.sum("rows").alias("class_size"))
    by_content = rooted.join(classes, "root").select("content", "first", "class_size")
    single: Column = F.col("n") == 0
    out = prints.join(by_content, "content", "left")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return out.select(
        "doc_id", "text_key", F.when(single, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(single, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"), (single | same).alias("keep"),
    )
