"""Landing-folder bookkeeping: what arrived, what was empty, what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.sources.csv import EMPTY_BODIES, FILE_KEY, key_from_file


def classify_payloads(
    spark: SparkSession, path: str, glob: str = "*.csv", key_pattern: str = FILE_KEY,
) -> DataFrame:
    """One row per landed file: path, key, bytes, lines and class.

    ``ok`` has a header and data; ``empty`` says there is none; ``failed`` is
    blank, header-only or an error body.  Names come from Spark's file index,
    since scans leave out files of zero bytes; sizes are read without content,
    and lines are counted in parallel splits, so one huge file costs no more
    than its share.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").load(path)
    )
    names = spark.createDataFrame([(name,) for name in files.inputFiles()], "path string")
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("line"))
        .where("line <> ''")
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.min("line").alias("_line"))
    )
    single = F.col("n_lines") == 1
    kind = (
        F.when(F.col("n_lines").isNull(), "failed")
        .when(single & F.col("_line").isin(*EMPTY_BODIES), "empty")
        .when(single, "failed")
        .otherwise("ok")
    )
    # The same file may be spelled file:/x or file:///x: compare what follows the scheme.
    bare = F.regexp_replace("path", r"^[a-z0-9]+:/+", "/")
    sizes = files.select(bare.alias("_bare"), F.col("length").alias("_bytes"))
    return (
        names.withColumn("_bare", bare).join(sizes, "_bare", "left")
        .join(lines.withColumn("_bare", bare).drop("path"), "_bare", "left")
        .select(
            "path", key_from_file("path", key_pattern).alias("ticker"),
            F.coalesce("_bytes", F.lit(0)).cast("bigint").alias("n_bytes"),
            F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"), kind.alias("class"),
        )
    )


def dead_letters(classified: DataFrame, day: Column | None = None) -> DataFrame:
    """Key and date of files that did not deliver."""
    day = F.current_date() if day is None else day
    return classified.where(F.col("class") == "failed").select("ticker", day.alias("date"))


def append_dead_letters(classified: DataFrame, path: str) -> None:
    dead_letters(classified).write.mode("append").parquet(path)


def ingest_report(classified: DataFrame, batch: str = "batch") -> DataFrame:
    """Processed, empty and failed keys of each batch, and of all (batch is null)."""
    return classified.rollup(batch).agg(
        F.count_if(F.col("class") == "ok").alias("processed"),
        F.count_if(F.col("class") == "empty").alias("empty_responses"),
        F.count_if(F.col("class") == "failed").alias("failed"),
    )
