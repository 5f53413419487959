"""Aggregation, pivoting, profiling and unpivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.scalars import quote_link
from quantloom.operators.selection import exact_quantiles


def pivot_values(df: DataFrame, on: str) -> list[str]:
    """Distinct pivot values, in order: the names of columns, which every plan holds as its schema."""
    return sorted(r[0] for r in df.select(on).where(F.col(on).isNotNull()).distinct().collect())


def pivot_multi(
    df: DataFrame, on: str, values: Sequence[str], group: Sequence[str],
    columns: Sequence[str], order: str,
) -> DataFrame:
    """Pivot with several columns at once: ``<value>_<column>``, first value by ``order``.

    Written as conditional aggregates, which combine on the map side.
    """
    picked = [
        F.min_by(F.when(F.col(on) == v, F.col(c)), F.when(F.col(on) == v, F.col(order)))
        .alias(f"{v}_{c}")
        for v in values for c in columns
    ]
    return df.groupBy(*group).agg(*picked)


def pivot_sum(
    df: DataFrame, on: str, value: str, group: Sequence[str],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide with sums.

    Pass ``values`` to fix the columns and save a job; where their number is
    open, ``pivot_map`` keeps them as data.
    """
    values = pivot_values(df, on) if values is None else list(values)
    return df.groupBy(*group).pivot(on, values).agg(F.sum(value))


def pivot_map(
    df: DataFrame, on: str, value: str, group: Sequence[str], name: str = "metrics",
) -> DataFrame:
    """Long to wide with sums, for any number of metrics: one map of metric to sum per group.

    No metric is named in the plan and none passes the driver.  Sums combine on
    the map side, so a group receives each of its metrics once from a task and
    its row is as large as the metrics it has.  Rows without a metric add
    nothing; a group of only such rows has an empty map.
    """
    sums = df.groupBy(*group, on).agg(F.sum(value).alias("_sum"))
    entry = F.when(F.col(on).isNotNull(), F.struct(F.col(on).alias("k"), F.col("_sum").alias("v")))
    return sums.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))


def map_columns(wide: DataFrame, values: Sequence[str], name: str = "metrics") -> DataFrame:
    """The listed metrics of ``pivot_map`` as columns; null where a group has no such metric.

    A look-up reads through the map, so this is for a few metrics of many;
    ``pivot_sum`` with ``values`` is for many.
    """
    kept = [c for c in wide.columns if c != name]
    return wide.select(*kept, *[F.try_element_at(name, F.lit(v)).alias(v) for v in values])


def global_max(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.max(column).alias(name))


def first_per_group(df: DataFrame, group: Sequence[str], value: str, order: str, name: str) -> DataFrame:
    """The group's value at the smallest ``order``."""
    return df.groupBy(*group).agg(F.min_by(value, order).alias(name))


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def series_summary(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Last date and value of each key, its history as a list, and a link.

    The list holds one entry per key and calendar day: ``time`` must be a DATE,
    and repeated days are reduced before the list is built.
    """
    if not isinstance(df.schema[time].dataType, T.DateType):
        raise ValueError(f"{time} must be a DATE")
    daily = df.groupBy(key, time).agg(F.min(value).alias("_value"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(time), F.col("_value"))))
    return (
        daily.groupBy(key)
        .agg(
            F.max(time).alias(time), F.max_by("_value", time).alias(value),
            F.transform(pairs, lambda p: p["_value"].cast("bigint")).alias("history"),
        )
        .withColumn("url", quote_link(key))
    )


def bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column, in one pass."""
    aggregates: list[Column] = []
    for c in columns:
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggregates)


def facet_values(
    df: DataFrame, facet: str, parent: str | None = None, chosen: Sequence[str] = (),
) -> DataFrame:
    """Sorted values of a facet, limited to the chosen values of a parent facet."""
    rows = df.where(F.col(parent).isin(list(chosen))) if parent and chosen else df
    return rows.select(facet).distinct().orderBy(F.col(facet).asc_nulls_first())


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, row count and number of nulls."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    described = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_{i}").alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return counted.select(F.col("_rows").alias("n_rows"), F.inline(described))


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


_QUARTERS = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and quartiles of numeric columns.

    Quartiles are exact, at the cost of a few more passes that narrow each of
    them down (see ``selection``); a quartile is the smallest value that so many
    rows do not exceed.
    With ``accuracy`` they come from a mergeable sketch in the same
    pass as the rest, with rank error ``rows / accuracy``.
    """
    aggregates: list[Column] = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggregates += [
            F.count(v).alias(f"n{i}"), F.count_if(v.isNull()).alias(f"z{i}"),
            F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"),
        ]
        if accuracy is not None:
            aggregates.append(
                F.percentile_approx(v, list(_QUARTERS.values()), accuracy).alias(f"q{i}"),
            )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("_c"), F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
            F.col(f"z{i}").alias("null_count"), F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"a{i}").alias("min"),
            *([] if accuracy is None else [F.get(f"q{i}", F.lit(j)).alias(n) for j, n in enumerate(_QUARTERS)]),
            F.col(f"b{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ])
    out = df.agg(*aggregates).select(F.inline(rows))
    if accuracy is None:
        out = out.join(F.broadcast(exact_quantiles(df, columns, _QUARTERS)), "_c", "left")  # one row for each column
    return out.select("column", "count", "null_count", "mean", "std", "min", *_QUARTERS, "max")


def describe_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, nulls and extremes of columns of any type, the extremes as text."""
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"n{i}"), F.count_if(F.col(c).isNull()).alias(f"z{i}"),
            F.min(c).cast("string").alias(f"a{i}"), F.max(c).cast("string").alias(f"b{i}"),
        ]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"z{i}").alias("null_count"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"))
        for i, c in enumerate(columns)
    ])
    return df.agg(*aggregates).select(F.inline(rows))


def rmse(df: DataFrame, actual: str, predicted: str, name: str = "rmse") -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(error * error)).alias(name))


def unpivot_features(
    df: DataFrame, ids: Sequence[str], features: Mapping[str, Mapping[str, Column]],
) -> DataFrame:
    """One row per feature; ``features`` maps a name to the columns of its row."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("feature"), *[c.alias(n) for n, c in columns.items()])
        for name, columns in features.items()
    ])
    return df.select(*ids, F.inline(rows))
