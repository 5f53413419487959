"""Writing tables: refresh, keyed upsert, constraint check, clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators.windows import dedupe_latest


def full_refresh(df: DataFrame, path: str, ddl: str | None = None) -> None:
    """Replaces the table's content; with ``ddl`` the columns are bound by name."""
    if ddl is not None:
        from quantloom.sources.csv import cast_to

        df = cast_to(df, ddl)
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replaces a catalog table with the rows of ``df`` and returns it; ``path`` keeps it external."""
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Target with updates: an update replaces the row of its key, new keys are added.

    Several updates of one key are reduced to the first by ``order`` (state a
    total order); without it the updates must be unique.
    """
    if order is not None:
        updates = dedupe_latest(updates, keys, order)
    updates = updates.select(*target.columns)
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates)


def with_slice(df: DataFrame, key: str, time: str, buckets: int, name: str = "slice") -> DataFrame:
    """Adds the partition of a keyed time series: year and hash bucket of the key.

    A daily load touches the slices of one year, a restated key one bucket of
    every year.  It is never null; rows without a time share a slice per bucket.
    """
    year = F.coalesce(F.year(time).cast("string"), F.lit("none"))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")
    return df.withColumn(name, F.concat(F.lit("y"), year, F.lit("-b"), bucket))


def upsert_partitions(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition: str,
    order: Sequence[Column] | None = None,
) -> None:
    """Upserts into a Parquet table partitioned by ``partition``, which must follow from the keys.

    Only partitions that receive updates are written again.  They are found by
    a semi join, which prunes the scan where the partitions are few; a null
    partition is one of them.  Task retries are safe, since new files replace
    old ones only when all are written; where readers need one switch for the
    whole table, write a new version folder instead.
    """
    if order is not None:
        updates = dedupe_latest(updates, keys, order)
    table = spark.read.parquet(path)
    touched = updates.select(partition).distinct()
    named = table.join(touched.where(F.col(partition).isNotNull()), partition, "left_semi")
    unnamed = table.where(F.col(partition).isNull() & touched.where(F.col(partition).isNull()).exists())
    old = named.select(*table.columns).unionByName(unnamed.select(*table.columns))
    merged = upsert(old, updates, keys)
    # Rebalanced by AQE: few files for a small partition, several tasks for a large one.
    (
        merged.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Returns ``df`` when its keys are unique, else raises with one example."""
    example = duplicate_keys(df, keys).take(1)
    if example:
        raise ValueError(f"duplicate key {example[0].asDict()} for primary key {list(keys)}")
    return df


def clustered_write(
    df: DataFrame, path: str, key: str, order: Sequence[str], partitions: int | None = None,
) -> None:
    """Parquet clustered for lookups: range-split by key and order, sorted within files.

    Range splits keep files even when one key dominates, and give narrow
    min/max statistics that skip files.
    """
    columns = [key, *[c for c in order if c != key]]
    spread = (
        df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    )
    spread.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def bucketed_table(
    df: DataFrame, name: str, key: str, order: Sequence[str], buckets: int, path: str | None = None,
) -> DataFrame:
    """Catalog table bucketed by key, so later joins and windows on it need no shuffle; returns the table.

    With ``path`` the files lie there, outside the warehouse.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def add_load_timestamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return df.withColumn("_etl_loaded_at", at)
