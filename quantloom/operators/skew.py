"""Hot keys: finding them, and cutting their rows into time slices.

An ordered window puts every row of a key into one task.  That is right for
ordinary keys and ruinous for a key that holds a large share of a big table.
The helpers here find keys above a row limit with one map-side-combined count
and cut only those keys into slices of about equal size along their order.
Ordinary keys keep the plain one-shuffle plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.session import checkpointed

# Rows of one key that a single task may order.
MAX_GROUP_ROWS = 2_000_000
# A limit below SLICE_ROWS would cut a big table into more slices than tasks can be started for;
# slices then hold up to SLICE_ROWS, or as many as make FEW_SLICES of the table.
SLICE_ROWS, FEW_SLICES = 200_000, 64
# Rows (of a few bytes each) that may be broadcast once counted.
MAX_BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class HotKeys:
    """Keys above the limit: at most ``total rows / limit`` of them, with ``rows`` rows together."""

    keys: DataFrame
    columns: list[str]
    n_keys: int
    rows: int
    limit: int

    @property
    def n_slices(self) -> int:
        by_limit, by_size = ceil(self.rows / self.limit), ceil(self.rows / SLICE_ROWS)
        return max(2, min(by_limit, max(FEW_SLICES, by_size)))

    @property
    def small(self) -> bool:
        return self.n_keys + self.n_slices <= MAX_BROADCAST_ROWS


def find_hot_keys(df: DataFrame, columns: list[str], limit: int = MAX_GROUP_ROWS) -> HotKeys | None:
    """Keys of ``df`` with more than ``limit`` rows, or ``None``."""
    counts = (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit)
    )
    seen = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).first()
    if seen["n"] == 0:
        return None
    return HotKeys(checkpointed(counts.select(*columns)), columns, seen["n"], seen["rows"], limit)


def _same_key(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Broadcasts a side whose size was counted and found small; else leaves it to AQE."""
    return F.broadcast(df) if small else df


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """``(rows of ordinary keys, rows of hot keys)``."""
    keys = hinted(hot.keys, hot.small)
    condition = _same_key(df, keys, hot.columns)
    return df.join(keys, condition, "left_anti"), df.join(keys, condition, "left_semi")


def join_on_keys(left: DataFrame, right: DataFrame, columns: list[str], small: bool) -> DataFrame:
    """Left join with null-safe keys that keeps the left side's key columns."""
    renamed = right.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)],
        *[c for c in right.columns if c not in columns],
    )
    condition = F.lit(True)
    for i, c in enumerate(columns):
        condition = condition & left[c].eqNullSafe(renamed[f"_k{i}"])
    joined = left.join(hinted(renamed, small), condition, "left")
    return joined.drop(*[f"_k{i}" for i in range(len(columns))])


def with_slices(hot_rows: DataFrame, hot: HotKeys, order: list[str]) -> DataFrame:
    """Adds ``_slice``: rows of hot keys cut along ``order`` into pieces of about equal size.

    Rows are range-partitioned by key, order and a hash of the row
    (``_spread``), so many rows of one instant are cut as well; a slice is a
    partition of the checkpointed result, and slices follow the order.  Their
    number follows the rows, not the limit (``HotKeys.n_slices``).
    """
    hashed = [c for c in hot_rows.columns if "map" not in hot_rows.schema[c].dataType.simpleString()]
    spread = hot_rows.withColumn("_spread", F.xxhash64(*hashed))
    cut = spread.repartitionByRange(hot.n_slices, *hot.columns, *order, "_spread")
    return checkpointed(cut.withColumn("_slice", F.spark_partition_id()))


def with_exact_row_number(
    sliced: DataFrame, hot: HotKeys, order: list[Column], name: str = "_rn",
) -> DataFrame:
    """Row number within each whole key, computed slice by slice."""
    sizes = sliced.groupBy(*hot.columns, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*hot.columns).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *hot.columns, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    joined = join_on_keys(sliced, offsets, [*hot.columns, "_slice"], hot.small)
    within = F.row_number().over(W.partitionBy(*hot.columns, "_slice").orderBy(*order, "_spread"))
    return joined.withColumn(name, F.col("_offset") + within).drop("_offset")
