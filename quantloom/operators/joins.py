"""Joins: as-of, equi, semi and anti.

Sides whose size the data model bounds (one row per calendar day) are
broadcast.  Every other join carries no hint: Spark picks from statistics and
AQE re-plans from measured sizes and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.skew import (
    MAX_GROUP_ROWS,
    find_hot_keys,
    join_on_keys,
    split_hot,
    with_slices,
)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    how: str = "inner",
    tie_break: Sequence[str] = (),
    suffix: str = "_right",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Both sides go through one shuffle by key as a single tagged stream, in
    which the latest right row is carried forward: linear in the input, no
    candidate pairs.  Among right rows of equal time the last in ``tie_break``
    order wins.  Keys above ``max_group_rows`` are cut into time slices, and
    each slice starts from the last right row before it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type: {how!r}")
    on = list(on)
    payload = [c for c in right.columns if c not in on]
    right_struct = F.struct(*[F.col(c) for c in payload])
    left_struct = F.struct(*[F.col(c) for c in left.columns])
    ties = [f"_tie{i}" for i in range(len(tie_break))]

    known = right.where(F.col(right_time).isNotNull())
    for c in on:
        known = known.where(F.col(c).isNotNull())
    r = known.select(
        *on, F.col(right_time).alias("_time"), F.lit(0).alias("_side"),
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties)],
        right_struct.alias("_right"),
    )
    l_ = left.select(
        *on, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), left_struct.alias("_left"),
    )
    stream = r.unionByName(l_, allowMissingColumns=True)
    order = [F.col(c).asc() for c in ("_time", "_side", *ties)]

    def carried(rows: DataFrame, part: list[str]) -> DataFrame:
        spec = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return rows.withColumn("_match", F.last("_right", ignorenulls=True).over(spec)).where(
            F.col("_side") == 1,
        )

    hot = find_hot_keys(stream, on, max_group_rows) if max_group_rows else None
    if hot is None:
        matched = carried(stream, on)
    else:
        ordinary, hot_rows = split_hot(stream, hot)
        sliced = with_slices(hot_rows, hot, ["_time", "_side", *ties])
        rank = F.when(F.col("_side") == 0, F.struct("_time", *ties))
        closing = sliced.groupBy(*on, "_slice").agg(F.max_by("_right", rank).alias("_closing"))
        before = W.partitionBy(*on).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
        opening = closing.select(
            *on, "_slice", F.last("_closing", ignorenulls=True).over(before).alias("_opening"),
        )
        inside = carried(sliced, [*on, "_slice"])
        filled = join_on_keys(inside, opening, [*on, "_slice"], hot.small).withColumn(
            # A left row without a time has no predecessor.
            "_match", F.coalesce("_match", F.when(F.col("_time").isNotNull(), F.col("_opening"))),
        )
        cols = [c for c in stream.columns] + ["_match"]
        matched = carried(ordinary, on).select(*cols).unionByName(filled.select(*cols))
    if how == "inner":
        matched = matched.where(F.col("_match").isNotNull())
    taken = set(left.columns)
    return matched.select(
        "_left.*",
        *[F.col("_match")[c].alias(c + suffix if c in taken else c) for c in payload],
    )


def inner_join(left: DataFrame, right: DataFrame, using: Sequence[str]) -> DataFrame:
    return left.join(right, list(using), "inner")


def join_calendar(df: DataFrame, days: DataFrame, time: str) -> DataFrame:
    """Inner join to a table with one row per calendar day, which bounds its size.

    Both halves of that bound are checked: the type is DATE, and a day that
    occurs twice fails the query.
    """
    if not isinstance(days.schema[time].dataType, T.DateType):
        raise ValueError(f"{time} must be a DATE to be joined as a calendar")
    others = [c for c in days.columns if c != time]
    single = days.where(F.col(time).isNotNull()).groupBy(time).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others],
    )
    twice = F.raise_error(F.concat(F.lit("calendar day occurs twice: "), F.col(time).cast("string")))
    checked = single.withColumn(time, F.when(F.col("_n") == 1, F.col(time)).otherwise(twice.cast("date")))
    return df.join(F.broadcast(checked.select(*days.columns)), time, "inner")


def left_join(left: DataFrame, right: DataFrame, using: Sequence[str]) -> DataFrame:
    return left.join(right, list(using), "left")


def left_join_upper(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, keep: Sequence[str] = (),
) -> DataFrame:
    """Left join where the left key is already upper case and the right one is not."""
    columns = list(keep) or [c for c in right.columns if c not in left.columns]
    other = right.select(F.upper(F.col(right_key)).alias("_upper"), *columns)
    return left.join(other, left[left_key] == other["_upper"], "left").drop("_upper")


def semi_join_upper(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
) -> DataFrame:
    """Left rows whose key occurs on the right, ignoring case."""
    names = right.select(F.upper(F.col(right_key)).alias("_upper")).distinct()
    return left.join(names, F.upper(left[left_key]) == names["_upper"], "left_semi")


def anti_join(left: DataFrame, right: DataFrame, using: Sequence[str]) -> DataFrame:
    return left.join(right.select(*using).distinct(), list(using), "left_anti")


def with_scalar(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a whole-table aggregate to every row as a scalar subquery."""
    return df.withColumn(name, df.agg(value).scalar())
