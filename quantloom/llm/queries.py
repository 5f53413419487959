"""The operators applied to the driver's tables with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm import alignment, bpe, decontaminate, language, licenses, lm, minhash, packing, passages, ranking, secrets, vectors, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document, learned from six of seven folds."""
    docs = lm.folds(_table(spark, sf_dir, "documents"))
    return lm.score(docs, lm.train(docs.where(~F.col("held_out"))))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, each distinct text scanned once."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE_KINDS)
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"), secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key", "items")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two of three folds."""
    docs = language.held_out(_table(spark, sf_dir, "documents"))
    model = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs, model, keep=("doc_id", "held_out"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back through the capture index."""
    found = warc.archive_and_read(spark, _table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in training sequences of 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return vectors.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document; the detections as ``label:first:last``."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    texts = F.transform("detections", lambda d: F.concat_ws(":", d["label"], d["first_word"], d["last_word"]))
    return found.withColumn("detections", F.concat_ws(",", texts))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of documents, in words, that are made of passages which stand elsewhere too."""
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_word", "last_word", "others")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of byte-level and sentence-piece tokens of every document."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(_table(spark, sf_dir, "documents"), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by a public rank file, and what they decode to, as digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranking.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_secret_scan, op3_decontamination, op4_language_id, op5_warc_index, op6_best_fit_packing, op7_minhash_dedup, op8_vector_search, op9_license_scan, op10_suffix_dedup, op11_token_alignment, op12_bpe_codec, op13_lexical_search)}
ORACLE_SQL: dict[str, str] = {"op2_secret_scan": secrets.ORACLE, "op3_decontamination": decontaminate.ORACLE, "op5_warc_index": warc.ORACLE, "op13_lexical_search": ranking.ORACLE}
