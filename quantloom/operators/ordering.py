"""Global order: positions, halves, batches, top-k and samples.

Positions over a whole table are counted per sorted partition and shifted by
the sizes of the partitions before it, so no single task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.session import checkpointed

# Rows that a task sorts, and parts of a table for each piece that a group may be cut into.
PART_ROWS, GROUP_SHARE = 250_000, 8
_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, position below


def with_row_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "index", start: int = 0,
) -> DataFrame:
    """Consecutive position in ``order``, which must be total."""
    stored = checkpointed(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    stored = stored.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition: as small as spark.sql.shuffle.partitions.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_base") + local + start)
        .drop("_part", "_mid", "_base")
    )


def with_running_total(
    df: DataFrame, order: Sequence[Column | str], weight: str, name: str = "upto",
) -> DataFrame:
    """Sum of ``weight`` over all rows up to and including each row in ``order`` (a total order).

    Totals run within sorted partitions of about equal size and are shifted by
    the partitions before.
    """
    stored = checkpointed(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    stored = stored.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored.groupBy("_part").agg(F.sum(weight).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"),
    )
    within = W.partitionBy("_part").orderBy("_mid").rowsBetween(W.unboundedPreceding, 0)
    return (
        stored.withColumn(name, F.sum(weight).over(within))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col(name) + F.col("_base"))
        .drop("_part", "_mid", "_base")
    )


def half_split(keys: DataFrame, key: str, first: bool) -> DataFrame:
    """First floor(n/2) keys in order, or the rest."""
    indexed = with_row_index(keys, [F.col(key).asc_nulls_last()], "_index")
    half = indexed.agg(F.floor(F.count(F.lit(1)) / 2)).scalar()
    wanted = F.col("_index") < half if first else F.col("_index") >= half
    return indexed.where(wanted).drop("_index")


def half_for_hour(keys: DataFrame, key: str, hour: int) -> DataFrame:
    """Even hours take the first half, odd hours the second."""
    return half_split(keys, key, first=hour % 2 == 0)


def assign_batches(keys: DataFrame, key: str, size: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` keys in order; ``size=0`` is one batch."""
    if size < 0:
        raise ValueError("batch size must not be negative")
    if size == 0:
        return keys.withColumn(name, F.lit(0).cast("bigint"))
    indexed = with_row_index(keys, [F.col(key).asc_nulls_last()], "_index")
    return indexed.withColumn(name, F.floor(F.col("_index") / size)).drop("_index")


def sample_n(df: DataFrame, n: int, identity: Sequence[str], seed: int = 0) -> DataFrame:
    """A fixed-size sample, the same for any partitioning: the n smallest row hashes."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in identity], F.lit(str(seed)))
    return (
        df.withColumn("_hash", F.md5(text)).orderBy("_hash", *identity).limit(n)
        .drop("_hash").orderBy(*identity)
    )


def head_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail_rows(df: DataFrame, reversed_order: Sequence[Column], n: int) -> DataFrame:
    """Last rows: the first ones in the reversed order."""
    return df.orderBy(*reversed_order).limit(n)


def by_magnitude(df: DataFrame, value: str, first: Sequence[Column | str] = ()) -> DataFrame:
    """Sorted by ``first``, then by the size of ``value``, largest first."""
    return df.orderBy(*first, F.abs(F.col(value)).desc())


def top_by_magnitude(
    df: DataFrame, groups: Sequence[str], value: str, k: int, tie_break: Sequence[Column],
) -> DataFrame:
    """The k largest values of each group.

    Rows are dealt by group into parts of ``PART_ROWS``, a group over several of
    them, so the memory of a task does not grow with the table (counts its
    rows); a part sends at most k rows per group.  By itself AQE would merge the
    shuffle before by bytes sent, and a task then sorts many times those.
    """
    order = [F.abs(F.col(value)).desc(), *tie_break]
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, ceil(df.count() / PART_ROWS))
    dealt = df
    simple = [c for c in df.columns if "map" not in df.schema[c].dataType.simpleString()]
    if parts > cores:
        dealt = df.repartition(parts, *groups, F.pmod(F.xxhash64(*simple), F.lit(ceil(parts / GROUP_SHARE))))
    return dealt.withColumn("rank", F.row_number().over(W.partitionBy(*groups).orderBy(*order))).where(F.col("rank") <= k)


def in_key_order(df: DataFrame, key: str, time: str) -> DataFrame:
    return df.orderBy(F.col(key).asc_nulls_last(), F.col(time).desc())
