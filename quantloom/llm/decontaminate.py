"""Benchmark decontamination through a distributed positional inverted index.

Training texts are cut into blocks of a few hundred rows.  A posting row holds
one term of one block: the rows and word positions where it stands; one more
row of the block names its texts, by id and content.  A phrase
is looked up by its rarest terms: the posting rows of the rarest term are met
with those of the next ones in the same block, shifted by the offsets of the
terms in the phrase, and what is left are its possible places.  Each is then
compared with the words of the text itself.

Test items are worked off in blocks of about ``BLOCK_WINDOWS`` distinct windows.
Workers hold a block's terms and one key per window; which items a window
belongs to is joined in afterwards, so a window that all items share costs no
more than another.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm.store import written
from quantloom.llm.text import chunks, tokenise, windowed

WIDTH = 10
BLOCK_WINDOWS = 500_000
ANCHORS = 3

#: Postings have rows and positions; the row of a block's texts (a null term) has ids and keys instead.
POSTINGS = "block long, term long, rows binary, positions binary, ids array<long>, keys array<long>"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _word_lists(texts: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident`` as text and the hashes of the words, in order."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            tokens = tokenise(part.column("text"))
            words = pa.ListArray.from_arrays(pa.array(tokens.bounds, pa.int32()), pa.array(_signed(tokens.hashes)))
            yield pa.RecordBatch.from_arrays([part.column("item"), words], ["item", "words"])

    rows = texts.select(F.col(ident).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(split, "item string, words array<long>")


def window_table(items: DataFrame, width: int = WIDTH, ident: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words) of every window; an item of fewer words, but not none, is one window."""
    words = _word_lists(items, ident, text).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, width))).alias("words")).distinct()


def window_key(words: np.ndarray) -> int:
    """The hash of one window; the number of words is part of it through the table that holds it."""
    return int(_signed(windowed(words.view(np.uint64), len(words)))[0])


def scan_terms(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """One pass: (kind 0) each row's id, text hash and number of words, (kind 1) occurrences of each term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        totals = np.zeros(len(wanted), np.int64)

        def emit(kind: int, ident: pa.Array, key: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), ident, key, pa.array(n)], ["kind", "doc_id", "key", "n"])

        for part in chunks(batches):
            tokens = tokenise(part.column("text"))
            at = np.minimum(np.searchsorted(wanted, tokens.hashes), len(wanted) - 1)
            totals += np.bincount(at[wanted[at] == tokens.hashes], minlength=len(wanted))
            yield emit(0, part.column("doc_id"), part.column("text_key"), tokens.counts.astype(np.int64))
        seen = np.flatnonzero(totals)
        yield emit(1, pa.nulls(len(seen), pa.int64()), pa.array(_signed(wanted[seen])), totals[seen])

    return docs.mapInArrow(count, "kind int, doc_id long, key long, n long")


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Posting rows of the given terms over all rows of ``docs`` (doc_id, text_key, text); to be written before use, as blocks get random names."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for part in chunks(batches, size=4 << 20):
            tokens = tokenise(part.column("text"))
            at = np.minimum(np.searchsorted(wanted, tokens.hashes), len(wanted) - 1)
            hit = np.flatnonzero(wanted[at] == tokens.hashes)
            if not len(hit):
                continue
            hit = hit[np.argsort(at[hit], kind="stable")]
            owner = np.searchsorted(tokens.bounds, hit, "right") - 1
            place = (hit - tokens.bounds[owner]).astype("<i4")
            found, first = np.unique(at[hit], return_index=True)
            cuts = [*first.tolist(), len(hit)]
            lists = [(owner[a:b].astype("<i4").tobytes(), place[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
            rows, places = zip(*lists)
            whole = lambda c: pa.array([None] * len(lists) + [part.column(c).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lists) + 1, uuid.uuid4().int >> 65, np.int64)), pa.array([*_signed(wanted[found]).tolist(), None], pa.int64()),
                    pa.array([*rows, None], pa.binary()), pa.array([*places, None], pa.binary()), whole("doc_id"), whole("text_key"),
                ],
                ["block", "term", "rows", "positions", "ids", "keys"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(post, POSTINGS)


def _named(index: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (block, row, ...) with the doc_id and text_key of their texts."""
    texts = index.where("term is null").select("block", "ids", "keys")
    others = [c for c in places.columns if c not in ("block", "row")]
    return places.join(texts, "block").select(F.get("ids", F.col("row")).alias("doc_id"), F.get("keys", F.col("row")).alias("text_key"), *others)


def _aligned(rows: bytes, positions: bytes, offset: int) -> np.ndarray:
    """Row and phrase start in one number, for a term that stands ``offset`` words into the phrase."""
    return (np.frombuffer(rows, "<i4").astype(np.int64) << 32) + np.frombuffer(positions, "<i4") - offset


def rarest_terms(phrases: DataFrame, frequency: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """``phrases`` (words) with their rarest terms; phrases with a term that never occurs go."""
    each = phrases.select("words", F.posexplode("words").alias("offset", "term")).join(frequency, "term")
    picked = each.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("ranked"))
    return picked.where(F.size("ranked") == F.size("words")).select("words", F.slice("ranked", 1, anchors).alias("anchors"))


def phrase_candidates(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """(doc_id, text_key, starts): where the rarest terms of any phrase stand as the phrase wants them.

    Phrases with the same terms at the same distances, such as the overlapping
    windows of one passage, share one look-up.
    """
    first = F.col("anchors")[0]
    gap = lambda k: F.get(F.transform(F.slice("anchors", 2, ANCHORS), lambda a: F.struct(a["term"].alias("term"), (a["offset"] - first["offset"]).alias("gap"))), k)
    lookups = anchored.select(first["term"].alias("t1"), first["offset"].alias("offset"), gap(0).alias("a2"), gap(1).alias("a3"))
    lookups = lookups.groupBy("t1", "a2", "a3").agg(F.sort_array(F.collect_set("offset")).alias("offsets"))
    one = index.select("block", F.col("term").alias("t1"), F.col("rows").alias("r1"), F.col("positions").alias("p1"))
    met = lookups.join(one, "t1").select("block", "a2", "a3", "offsets", "r1", "p1")
    for k in (2, 3):
        other = index.select("block", F.col("term").alias(f"t{k}"), F.col("rows").alias(f"r{k}"), F.col("positions").alias(f"p{k}"))
        met = met.withColumn(f"t{k}", F.col(f"a{k}.term")).join(other, ["block", f"t{k}"], "left").where(F.col(f"a{k}").isNull() | F.col(f"r{k}").isNotNull())

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, rows, starts = [], [], []
            for x in batch.to_pylist():
                left = _aligned(x["r1"], x["p1"], 0)
                keep = np.ones(len(left), bool)
                for k in (2, 3):
                    if x[f"a{k}"] is not None:
                        keep &= np.isin(left, _aligned(x[f"r{k}"], x[f"p{k}"], x[f"a{k}"]["gap"]))
                if keep.any():
                    begun = np.concatenate([left[keep] - o for o in x["offsets"]])
                    owners = np.concatenate([np.frombuffer(x["r1"], "<i4")[keep]] * len(x["offsets"]))
                    good = begun >= owners.astype(np.int64) << 32
                    blocks.append(x["block"])
                    rows.append(owners[good].astype("<i4").tobytes())
                    starts.append((begun[good] & 0xFFFFFFFF).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(rows, pa.binary()), pa.array(starts, pa.binary())], ["block", "rows", "starts"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(frame["rows"]), "<i4").astype(np.int64)
        starts = np.frombuffer(b"".join(frame["starts"]), "<i4")
        pairs = np.unique((rows << 32) + starts)
        own, first = np.unique(pairs >> 32, return_index=True)
        begun = (pairs & 0xFFFFFFFF).astype("<i4")
        return pd.DataFrame({"block": frame["block"].iloc[0], "row": own.astype(np.int32), "starts": [x.tobytes() for x in np.split(begun, first[1:])]})

    places = met.select("block", "offsets", "r1", "p1", "a2", "r2", "p2", "a3", "r3", "p3").mapInArrow(intersect, "block long, rows binary, starts binary")
    found = _named(index, places.groupBy("block").applyInPandas(merge, "block long, row int, starts binary"))
    return found.dropDuplicates(["doc_id", "text_key"])  # the places follow from the text


def proximity_matches(index: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """(query, doc_id, start): places where all terms of a query stand within ``span`` words, in any order.

    ``queries`` has (query, words).  The places are those of the query's first
    word with every other one close enough; a null id comes back as null.
    """
    each = queries.select("query", F.size(F.array_distinct("words")).alias("n"), F.posexplode(F.array_distinct("words")).alias("nth", "term"))
    lists = each.join(index, "term").select("query", "block", "n", "nth", "rows", "positions")

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "block": [], "row": [], "start": []}).astype({"query": str, "block": "int64", "row": "int32", "start": "int32"})
        if len(frame) < frame["n"].iloc[0]:
            return empty
        frame = frame.sort_values("nth")
        spots = [np.sort(_aligned(r, p, 0)) for r, p in zip(frame["rows"], frame["positions"])]
        out = set()
        every = np.unique(np.concatenate(spots))
        for low in every.tolist():  # the leftmost word of a place
            if all((at := int(np.searchsorted(s, low))) < len(s) and s[at] < low + span and s[at] >> 32 == low >> 32 for s in spots):
                out.add((low >> 32, low & 0xFFFFFFFF))
        return pd.DataFrame({"query": frame["query"].iloc[0], "block": frame["block"].iloc[0], "row": [r for r, _ in sorted(out)], "start": [s for _, s in sorted(out)]}) if out else empty

    found = lists.groupBy("query", "block").applyInPandas(near, "query string, block long, row int, start int")
    return _named(index, found).select("query", "doc_id", "start")


def _verify(keyed: DataFrame, candidates: DataFrame, windows: pd.DataFrame) -> DataFrame:
    """(doc_id, text_key, hits, owners) of rows in which a window (words, owner) truly occurs."""
    lengths = sorted({len(w) for w in windows["words"]})
    tables = {}
    for n in lengths:
        own = windows[[len(w) == n for w in windows["words"]]]
        keys = np.array([window_key(np.asarray(w, np.int64)) for w in own["words"]], np.int64)
        order = np.argsort(keys, kind="stable")
        tables[n] = (keys[order], own["owner"].to_numpy(np.int64)[order])
    shared = keyed.sparkSession.sparkContext.broadcast(tables)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in chunks(batches):
            tokens = tokenise(part.column("text"))
            rows, hits, owned = [], [], []
            grams = {n: _signed(windowed(tokens.hashes, n)) for n in known}
            for row, starts in enumerate(part.column("starts").to_pylist()):
                low, high = int(tokens.bounds[row]), int(tokens.bounds[row + 1])
                at = np.frombuffer(starts, "<i4").astype(np.int64) + low
                struck, named = [], set()
                for n, (keys, named_by) in known.items():
                    begun = at[at + n <= high]
                    values = grams[n][begun]
                    first, last = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
                    real = last > first
                    struck += [begun[real] - low + k for k in range(n)]
                    for a, b in set(zip(first[real].tolist(), last[real].tolist())):
                        named.update(named_by[a:b].tolist())
                if named:
                    rows.append(row)
                    hits.append(np.unique(np.concatenate(struck)))
                    owned.append(sorted(named))
            picked = part.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([picked.column("doc_id"), picked.column("text_key"), pa.array(hits, pa.list_(pa.int64())), pa.array(owned, pa.list_(pa.int64()))], ["doc_id", "text_key", "hits", "owners"])

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    joined = keyed.join(candidates.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), same)
    return joined.select("doc_id", "text_key", "text", "starts").mapInArrow(check, "doc_id long, text_key long, hits array<long>, owners array<long>")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated and the item list.

    A null text has no words.  Items without words match nothing; items with a
    null id are left out.  Rows with the same id and text get the same result.
    Without items every row is clean.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    of_items = window_table(items.where(F.col("item_id").isNotNull()), width).groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    windows = written(of_items.withColumn("owner", F.xxhash64("items")), "windows")
    total = windows.count()
    n_blocks = max(1, -(-total // block_windows))
    sizes, found = None, None
    for block in range(n_blocks):
        own = windows.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == block) if n_blocks > 1 else windows
        terms = np.unique(own.select(F.explode("words").alias("w")).distinct().toPandas()["w"].to_numpy(np.int64).view(np.uint64))
        if not len(terms):
            terms = np.zeros(1, np.uint64)
        scanned = written(scan_terms(keyed, terms), "terms")
        sizes = sizes if sizes is not None else scanned.where("kind = 0").select("doc_id", F.col("key").alias("text_key"), F.col("n").alias("n_words"))
        frequency = scanned.where("kind = 1").groupBy(F.col("key").alias("term")).agg(F.sum("n").alias("n"))
        anchored = written(rarest_terms(own.select("words"), frequency), "anchors")
        wanted = np.unique(anchored.select(F.explode("anchors.term").alias("w")).distinct().toPandas()["w"].to_numpy(np.int64).view(np.uint64))
        if not len(wanted):
            continue
        index = written(build_index(keyed, wanted), "postings")
        candidates = phrase_candidates(index, anchored)
        verified = _verify(keyed, candidates, own.select("words", "owner").toPandas())
        found = verified if found is None else found.unionByName(verified)
    if found is None:
        merged = sizes.limit(0).select("doc_id", "text_key", F.lit(0).alias("n_hit"), F.array().cast("array<string>").alias("items"))
    else:
        # What the blocks of the benchmark and the repeats of a row say of one text, together.
        every = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
        struck = written(found.groupBy("doc_id", "text_key").agg(F.size(every("hits")).alias("n_hit"), every("owners").alias("owners")), "struck")
        lists = windows.select("owner", "items").dropDuplicates(["owner"])
        merged = struck.withColumn("owner", F.explode("owners")).join(lists, "owner").groupBy("doc_id", "text_key").agg(F.first("n_hit").alias("n_hit"), F.array_sort(every("items")).alias("items"))
    merged = written(merged, "hits").withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same: Column = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return sizes.join(merged, same, "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), listed.alias("items"),
    )


#: The same for DuckDB.
ORACLE = rf"""
with lowered as (
    select row_number() over () as rid, doc_id, regexp_extract_all(
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') as w
    from documents),
items as (
    select cast(item_id as varchar) as item, regexp_extract_all(
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') as w
    from benchmark where item_id is not null),
starts as (
    select item, w, unnest(range(1, greatest(len(w) - {WIDTH} + 1, 1) + 1)) as k from items where len(w) > 0),
windows as (select distinct item, w[k:k + {WIDTH - 1}] as g from starts),
lengths as (select distinct len(g) as n from windows),
grams as (
    select rid, k, n, w[k:k + n - 1] as g
    from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as k from lowered, lengths where len(w) >= n)),
found as (select rid, k, n, item from grams join windows using (g)),
hits as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(k, k + n)) as p from found) group by rid),
named as (
    select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct rid, item from found) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from lowered left join hits using (rid) left join named using (rid)
"""
