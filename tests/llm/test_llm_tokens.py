"""Token alignment, byte-level BPE and ranked search against the libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm import brute, brute_tokens
from pyspark.sql import functions as F

from quantloom.llm import alignment, bpe, ranking
from quantloom.llm.pieces import PieceCache
from quantloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, block long, nth int, term string, n long, ids string, item long"

RNG = random.Random(5)
LONG = "".join(RNG.choice("abcde") for _ in range(6000))
TEXTS = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "Hello, world! don't", "tabs\tand\r\nlines\n\n\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mark", "Ünï cödé 漢字 🙂🙂", "é ​ x",
    "the the the the", "a" * 700, LONG, " " * 400 + "x", "=-" * 300, "0123456789" * 60, "zero\0byte", "The CAT and the cat_dog; cat.", "ÉCOLE école",
]


def documents(spark, rows):
    """Rows with null values in columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, None, None, None, None, None, None) for d, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [*enumerate(TEXTS), (None, "null id"), (8, TEXTS[8]), (8, TEXTS[8]), (None, None)]
    return rows, documents(spark, rows)


@pytest.fixture(scope="module")
def table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


@pytest.mark.parametrize("block_bytes", [1, 900, 4 << 20])
def test_alignments_equal_all_pairs(spark, awkward, block_bytes):
    rows, docs = awkward
    got = alignment.align(docs.coalesce(2), *PATHS, block_bytes=block_bytes)
    assert values(got, *ALIGNED) == sorted(brute_tokens.alignments(rows), key=str)


def test_alignments_of_nothing(spark):
    assert alignment.align(documents(spark, []), *PATHS).collect() == []
    assert values(alignment.align(documents(spark, [(1, None), (2, "")]), *PATHS, digest=True), *ALIGNED) == [(d, 0, 0, 0, 0, "", 0, 0) for d in (1, 2)]


def test_the_registered_alignment(spark, table):
    want = [(*r[:5], brute_tokens.digest(r[5]), *r[6:]) for r in brute_tokens.alignments(table)]
    columns = [c if c != "groups" else "groups_sha256" for c in ALIGNED]
    assert values(QUERIES["op11_token_alignment"](spark, SF_DIR), *columns) == sorted(want, key=str)


def _ids(text):
    return np.array(brute_tokens.rank_encoding().encode_ordinary(text or ""), "<u4")


def _digests(rows):
    plain = brute_tokens.rank_encoding()
    out = []
    for d, t in rows:
        ids = np.array(plain.encode_ordinary(t or ""), "<u4")
        out.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_bpe_equals_the_library_and_comes_back(spark, awkward):
    rows, docs = awkward
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert values(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN), *columns) == _digests(rows)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert values(encoded, "doc_id", "ids") == sorted(((d, _ids(t).tolist()) for d, t in rows), key=str)
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert values(back.select("doc_id", F.col("data").cast("string").alias("t")), "doc_id", "t") == sorted(((d, t or "") for d, t in rows), key=str)
    assert bpe.round_trip(documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["data"]) for r in bpe.decode(nothing, RANKS, public_tokenizers.PATTERN).collect()] == [b"", b""]


def test_the_registered_codec(spark, table):
    assert values(QUERIES["op12_bpe_codec"](spark, SF_DIR), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _digests(table)


def test_merges_of_random_pieces_on_matrices_and_on_the_heap():
    """Also where a vocabulary has pairs that merge although their ranks are out of order."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"ca", b"cab", b"bcab", b"aa", b"aaaa", b"aaa"]
    own = bpe.ByteEncoder({t: k for k, t in enumerate(tokens)}, r"(?s).+")

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            ranked = [(own.ranks[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in own.ranks]
            if not ranked:
                return [own.ranks[p] for p in parts]
            k = min(ranked)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    rng = random.Random(3)
    pieces = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 300))) for _ in range(400)})
    ids, lengths = own.encode_pieces(pieces)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [[own.ranks[p]] if p in own.ranks else plain(p) for p in pieces]
    assert [own._long(p).tolist() for p in pieces if len(p) > 1] == [plain(p) for p in pieces if len(p) > 1]


def test_a_cache_that_overflows_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr("quantloom.llm.pieces.MAX_PIECES", 3)
    cache = PieceCache(lambda new: (np.array([len(p) for p in new]), np.ones(len(new), np.int64)))
    for _ in range(3):
        assert cache.lookup(["a", "bb", "a", "dddd", "ccc"])[0].tolist() == [1, 2, 1, 4, 3]
    assert cache.lookup([])[0].tolist() == []


def _ranking(docs, items, top):
    """Plain scores of all pairs."""
    words = re.compile(ranking.TERM)
    terms = lambda t: words.findall((t or "").translate(brute.LOW))
    texts = [(d, terms(t)) for d, t in docs]
    texts = [(d, w) for d, w in texts if w]
    n_docs, total = len(texts), sum(len(w) for _, w in texts)
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        rows = []
        for d, w in texts:
            m = 10 + 90 * len(w) * n_docs // total
            score = 0
            for term in wanted & set(w):
                df = sum(term in other for _, other in texts)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1_000_000_000 * w.count(term) // (1000 * w.count(term) + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=str)


RANKED = ("item_id", "rank", "doc_id", "score")


def test_ranks_equal_plain_scores(spark, awkward, monkeypatch):
    rows, docs = awkward
    rows = rows + [(100 + k, f"cat {'x ' * (k % 3)}naïve") for k in range(30)]
    docs = documents(spark, rows)
    asked = [(1, "The cat, the DOG"), (2, ""), (3, None), (None, "naïve x"), (4, "absent words"), (5, "école"), (1, "a"), (6, " ".join(t or "" for t in TEXTS))]
    items = spark.createDataFrame([(i, t, None) for i, t in asked], "item_id long, text string, term string")
    want = _ranking(rows, asked, 10)
    assert values(ranking.search(docs.repartition(5), items), *RANKED) == want
    monkeypatch.setattr(ranking, "CELLS", 40)  # few rows and pairs at a time
    assert values(ranking.search(docs, items, block_terms=7), *RANKED) == want  # several blocks of items
    assert values(ranking.search(docs, items, top=2), *RANKED) == _ranking(rows, asked, 2)


def test_ranks_of_nothing(spark, awkward):
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert ranking.search(documents(spark, []), items).collect() == []
    assert ranking.search(documents(spark, [(1, None), (2, "--")]), items).collect() == []
    assert ranking.search(awkward[1], items.limit(0)).collect() == []


def test_sums_that_doubles_cannot_hold():
    values_ = np.array([2**60, 1, 2**59 + 1], np.int64)
    assert ranking._add_up(np.array([0, 0, 1]), np.array([1, 1, 0]), values_, (2, 2)).tolist() == [[0, 2**60 + 1], [2**59 + 1, 0]]


def test_alignment_gives_memory_back_after_every_block(monkeypatch):
    """A worker's memory is that of one block of 2 MB, not of the largest blocks of all its tasks."""
    released, taken = [], {}

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            taken["run"] = run

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():  # noqa: N802
            return 0

    monkeypatch.setattr(alignment, "release", lambda: released.append(1))
    monkeypatch.setattr(alignment, "TaskContext", Context)
    monkeypatch.setattr(alignment.F, "col", lambda c: type("C", (), {"cast": lambda s, _: s, "alias": lambda s, _: s})())
    alignment.aligned(Docs(), *PATHS, block_bytes=40)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "text": ["some words " * 5] * 3})
    out = list(taken["run"](iter([batch])))
    assert len(out) == 6 and len(released) == 3
    assert alignment.BLOCK_BYTES <= 2 << 20


def test_alignment_of_any_blanks(spark):
    """Words are cut at blanks only where neither tokenizer goes on."""
    signs = [" ", " ", "  ", "\n", "\t", "\r\n", "\x1c", " ", " ", "\0", "a", "the", "Cat", "'s", "'", "12", ",", "é", "漢", "🙂", "▁"]
    rows = [(k, "".join(RNG.choice(signs[: RNG.choice([6, 12, 20, 21])]) for _ in range(RNG.randrange(14)))) for k in range(600)]
    rows += [(k, " ".join(RNG.choice(["the", "cat", "don't", "a,b", "x\n"]) for _ in range(30))) for k in range(600, 640)]
    for block_bytes in (200, 1 << 20):
        got = alignment.align(documents(spark, rows).coalesce(2), *PATHS, block_bytes=block_bytes)
        assert values(got, *ALIGNED) == sorted(brute_tokens.alignments(rows), key=str)


def test_words_are_aligned_once(monkeypatch):
    """The tokens that are matched are those of the distinct words, however often they come."""
    seen, links = [], alignment.links
    monkeypatch.setattr(alignment, "links", lambda a, b: seen.append(len(a.ids)) or links(a, b))
    schema = {"doc_id": pa.array(range(40), pa.int64()), "text": ["one two three two one " * 50] * 40}
    own = alignment.words_of(*PATHS)
    rows, _ = alignment._block(0, pa.RecordBatch.from_pydict(schema), own, False)
    assert sum(rows["n_a"]) > 40 * 250 and sum(seen) < 20


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "MAX_WORDS", 2)
    words = alignment.words_of(*PATHS)
    for texts in (["a b c", None, "c d"], ["c d", ""], ["d ▁ e", "e"]):
        own, counts = words.lookup(texts)
        assert [words.texts[k] != "" for k in own.tolist()] == ["▁" not in t for t in texts if t for _ in (t.split(" ") if "▁" not in t else [t])]
        assert counts.tolist() == [0 if not t else 1 if "▁" in t else len(t.split(" ")) for t in texts] and len(words.known) <= 8
