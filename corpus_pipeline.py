"""A corpus of documents from raw rows to packed training sequences, stage by stage.

Every stage works on all rows that the one before has kept and returns the
columns of ``documents``; the last returns one row per token piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import decontaminate, language, minhash, packing, secrets
from quantloom.llm.store import written
from quantloom.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A byte that belongs to a word; see text.ALNUM.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS).withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))


def _semi(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is, or is not, among the chosen (doc_id, text_key)."""
    other = chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_other")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_other"))
    return docs.join(other, same, how)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows; those that it rejects go."""
    model = language.fit(language.held_out(docs).where(~F.col("held_out")))
    return language.predict(docs, model, keep=COLUMNS).where(~F.col("rejected")).select(*COLUMNS)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class: the one with the smallest id.

    Repeats of that row count as one; texts without words are no duplicates of
    each other and all stay.
    """
    keyed = _keyed(docs)
    speaking = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    kept = minhash.near_duplicates(docs).where("keep")
    chosen = _semi(keyed.where(speaking), kept, "left_semi").dropDuplicates(["doc_id", "_key"])
    return chosen.select(*COLUMNS).unionByName(docs.where(~speaking).select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.contamination(docs, items).where("contaminated")
    return _semi(_keyed(docs), found, "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; ``n_chars`` follows the text.

    The texts stay where they are: findings meet them by content.
    """
    ledger = scratch_path(spark, "ledger")
    rows = docs.select(*COLUMNS)
    secrets.update_ledger(spark, rows, ledger)
    found = secrets.findings(spark, ledger)
    joined = rows.withColumn("blob", secrets.blob_of("text")).join(found, "blob", "left")
    text = F.when(F.col("spans").isNotNull(), secrets.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    size = F.when(F.col("spans").isNotNull(), F.char_length("clean").cast("long")).otherwise(F.col("n_chars"))
    return joined.withColumn("clean", text).withColumn("n_chars", size).withColumn("text", F.col("clean")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_each_class),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Centroids, hashing and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
