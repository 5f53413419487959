"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.session import scratch_path


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` to a new table below ``spark.checkpoint.dir`` and reads it back.

    It cuts the lineage: what follows reads the same rows again, whichever
    executor is lost meanwhile.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession, *paths: str) -> None:
    """Deletes intermediate tables of this run that nothing reads any more, and lets Spark drop the shuffle files of frames that are gone."""
    for path in paths:
        own = spark._jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    gc.collect()
    spark._jvm.System.gc()


def remainder(ident: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(ident.cast("string")) % divisor, F.lit(0)).cast("int")
