"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Letters are lower-cased and everything else becomes one blank; runs of two and
three bytes are hashed into ``DIMENSIONS`` buckets, weighted by
``(1 + ln tf) * idf`` and brought to length one.  For every language the
vectors of a bounded sample of labelled rows are clustered (spherical k-means)
into a few centroids.  A text gets the language of the centroid with the
largest cosine; a text whose cosine is below ``slack`` times that of the
language's furthest sampled member is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm.store import remainder, written
from quantloom.llm.text import CHUNK_BYTES, LOWER, chunks, raw_bytes, release

DIMENSIONS = 8192
_SHIFT = np.uint32(32 - 13)
_ORDERS = ((2, np.uint32(0x9E3779B1)), (3, np.uint32(0x85EBCA77)))
#: Bytes that stay: a-z and everything outside ASCII; the rest is a blank.
_LETTERS = np.where((LOWER >= 97) & (LOWER < 123) | (LOWER >= 128), LOWER, 32).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    """``centroids`` in rows, their languages, and the smallest cosine that is accepted."""

    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray


def _counts(column: pa.Array) -> np.ndarray:
    """How often each bucket occurs in each text."""
    data, offsets = raw_bytes(column)
    n = len(offsets) - 1
    letters = _LETTERS[data].astype(np.uint32)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    out = np.zeros((n, DIMENSIONS), np.int32)
    for order, factor in _ORDERS:
        m = len(letters) - order + 1
        if m <= 0:
            continue
        gram = letters[:m].copy()
        for k in range(1, order):
            gram = (gram << np.uint32(8)) | letters[k : k + m]
        bucket = ((gram * factor) >> _SHIFT).astype(np.int64)
        inside = owner[:m] == owner[order - 1 :]
        blank = (letters[:m] == 32) & (letters[1 : m + 1] == 32)  # runs of blanks count once
        keep = inside & ~blank
        out += np.bincount(owner[:m][keep] * DIMENSIONS + bucket[keep], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.int32)
    return out


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32) * idf
    length = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.where(length > 0, length, 1)


def _sample(train: DataFrame, text: str, lang: str, ident: str, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language by hash, never more than twice as many."""
    sizes = {r[lang]: r["n"] for r in train.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not sizes:
        return train.limit(0).select(lang, text)
    total = F.element_at(F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)), F.col(lang))
    share = (F.xxhash64(F.col(ident), F.xxhash64(text)) % (1 << 30) + (1 << 30)) / F.lit(float(1 << 31))
    few = train.where(share * total <= per_language)
    rank = F.row_number().over(Window.partitionBy(lang).orderBy(F.xxhash64(ident), F.xxhash64(text)))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= 2 * per_language).select(lang, text)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, size=CHUNK_BYTES // 2):
        for at in range(0, part.num_rows, 128):
            piece = part.slice(at, 128)
            buckets, counts = [], []
            for row in _counts(piece.column("text")):
                used = np.flatnonzero(row)
                buckets.append(used.astype("<u2").tobytes())
                counts.append(row[used].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], ["lang", "buckets", "counts"])


def _dense(frame: pd.DataFrame) -> np.ndarray:
    out = np.zeros((len(frame), DIMENSIONS), np.int32)
    for row, (buckets, counts) in enumerate(zip(frame["buckets"], frame["counts"])):
        out[row, np.frombuffer(buckets, "<u2")] = np.frombuffer(counts, "<u4")
    return out


def _cluster(vectors: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart seeds; returns centroids and each row's centroid."""
    seeds = [0]
    nearest = vectors @ vectors[0]
    while len(seeds) < min(k, len(vectors)):
        seeds.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[seeds[-1]])
    centroids = vectors[seeds]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def fit(train: DataFrame, text: str = "text", lang: str = "lang", ident: str = "doc_id", per_language: int = 400, clusters: int = 4, slack: float = 0.5) -> Model:
    """Fits the centroids on at most ``2 * per_language`` sampled rows of each language.

    Rows with a null language or text are left out.  What reaches the driver is
    bounded by languages x (clusters + 1) x ``DIMENSIONS`` numbers.
    """
    train = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(ident).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sample = _sample(train, "text", "lang", "doc_id", per_language)
    features = written(sample.mapInArrow(_features, "lang string, buckets binary, counts binary"), "language-sample")

    def frequencies(frame: pd.DataFrame) -> pd.DataFrame:
        df = (_dense(frame) > 0).sum(axis=0).astype("<i8")
        return pd.DataFrame({"n": [len(frame)], "df": [df.tobytes()]})

    parts = features.groupBy("lang").applyInPandas(frequencies, "n long, df binary").collect()
    total = sum(r.n for r in parts)
    df = sum((np.frombuffer(r.df, "<i8") for r in parts), np.zeros(DIMENSIONS, np.int64))
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def centroids(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = _unit(_dense(frame), idf)
        vectors = vectors[vectors.any(axis=1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        found, own = _cluster(vectors, clusters, 12)
        cosines = (vectors * found[own]).sum(axis=1)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": [c.astype("<f4").tobytes() for c in found], "floor": float(cosines.min())})

    rows = sorted(features.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, floor double").collect(), key=lambda r: (r["lang"], r["centroid"]))
    matrix = np.stack([np.frombuffer(r["centroid"], "<f4") for r in rows]) if rows else np.zeros((0, DIMENSIONS), np.float32)
    return Model([r["lang"] for r in rows], matrix, np.array([slack * r["floor"] for r in rows]), idf)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (the cosine) and ``rejected`` to the ``keep`` columns of every row.

    A null text, a text without a letter and any text under a model without
    languages get ``und``, 0 and are rejected.  Only the text is read; equal
    texts get equal answers, ties go to the first language by name.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded, see fit()
    # A kept text travels once: it leaves as it came, beside the other kept columns.
    others = [c for c in keep if c != text]
    kept = F.struct(*(F.col(c) for c in others)) if others else F.struct(F.lit(0).alias("_none"))
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"), kept.alias("_kept"))
    names_out = ["_kept", "lang_pred", "score", "rejected", *["text"] * (text in keep)]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = shared.value
        for part in chunks(batches, size=CHUNK_BYTES // 2):
            for at in range(0, part.num_rows, 128):
                piece = part.slice(at, 128)
                usable = piece.column("_letter").to_numpy(zero_copy_only=False) & bool(known.languages)
                names, scores, rejected = np.full(len(usable), "und", object), np.zeros(len(usable)), np.ones(len(usable), bool)
                if usable.any():
                    cosines = _unit(_counts(piece.column("text")), known.idf) @ known.centroids.T
                    best = np.argmax(cosines, axis=1)
                    top = np.clip(cosines[np.arange(len(best)), best].astype(float), 0, 1)
                    names[usable] = np.array(known.languages, object)[best[usable]]
                    scores[usable] = top[usable]
                    rejected[usable] = (top < known.floors[best])[usable]
                out = [piece.column("_kept"), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected), *[piece.column("text")] * (text in keep)]
                yield pa.RecordBatch.from_arrays(out, names_out)

    schema = T.StructType([rows.schema["_kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    if text in keep:
        schema.add("text", T.StringType())
    columns = [F.col("text").alias(text) if c == text else F.col(f"_kept.{c}") for c in keep]
    return rows.mapInArrow(label, schema).select(*columns, "lang_pred", "score", "rejected")


def held_out(docs: DataFrame) -> DataFrame:
    """``documents`` with the fold that language learning must not see."""
    return docs.withColumn("held_out", remainder(F.col("doc_id"), 3) == 1)
