"""Which companies are followed: universe, latest snapshot, metadata, work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.operators.filters import (
    exclude_keys,
    filter_universe,
    lookback,
    skip_existing,
)
from quantloom.operators.joins import semi_join_upper
from quantloom.operators.ordering import assign_batches, half_for_hour, sample_n
from quantloom.operators.windows import dedupe_latest


def selected_us_tickers(tickers: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """One row per followed ticker, the one that traded last."""
    order = [F.col("endDate").desc(), *tie_break]
    return dedupe_latest(filter_universe(tickers), ["ticker"], order)


def selected_last_trading_day(
    snapshot: DataFrame, universe: DataFrame, tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The latest prices of followed tickers, upper-cased, the largest dividend first."""
    followed = semi_join_upper(snapshot, universe, "ticker", "ticker").select(
        "date", "close", "adjClose", "adjVolume", F.upper("ticker").alias("ticker"),
        "splitFactor", "divCash",
    )
    return dedupe_latest(followed, ["ticker"], [F.col("divCash").desc(), *tie_break])


def selected_fundamentals(
    meta: DataFrame, universe: DataFrame, tie_break: Sequence[Column] = (),
) -> DataFrame:
    """One company per followed ticker, active and recent first; then only those with daily data."""
    followed = semi_join_upper(meta, universe, "ticker", "ticker")
    order = [F.col("isActive").desc(), F.col("statementLastUpdated").desc(), *tie_break]
    return dedupe_latest(followed, ["ticker"], order).where("dailyLastUpdated is not null")


def select_keys(
    companies: DataFrame,
    key: str = "ticker",
    tickers: Sequence[str] = (),
    updated: str | None = None,
    lookback_days: int = 0,
    as_of: Column | None = None,
    sample: int | None = None,
    seed: int = 0,
    hour: int | None = None,
    existing: DataFrame | None = None,
    skip: Sequence[str] = (),
    batch_size: int = 0,
) -> DataFrame:
    """The keys to load, with their batch.

    Steps in order: given tickers, or all companies updated lately (optionally a
    sample); half by the hour; not those already loaded; not those to skip;
    upper case; batches.
    """
    if tickers:
        # As they are given: a key that is not in the table yet is loaded too.
        given = sorted({t.upper() for t in tickers})
        keys = companies.sparkSession.createDataFrame([(t,) for t in given], f"{key} string")
    else:
        rows = lookback(companies, updated, lookback_days, as_of) if updated else companies
        keys = rows.select(key).distinct()
        if sample is not None:
            keys = sample_n(keys, sample, [key], seed)
    if hour is not None:
        keys = half_for_hour(keys, key, hour)
    if existing is not None:
        keys = skip_existing(keys, key, existing)
    keys = exclude_keys(keys, key, skip).select(F.upper(key).alias(key)).distinct()
    return assign_batches(keys, key, batch_size)
