"""Queries on the long prediction table and on price panels for display."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.functions.scalars import (
    forecast_date,
    horizon_label,
    horizon_months,
    jittered,
    sigma_band,
)
from quantloom.operators.filters import date_selection, facet_filter, include_keys, latest_only, lookup_day
from quantloom.operators.ordering import by_magnitude, head_rows, tail_rows
from quantloom.operators.selection import Key, pick_rows
from quantloom.operators.reshape import first_per_group, series_summary
from quantloom.operators.setops import union_all
from quantloom.operators.windows import relative_to_first
from quantloom.plans.features import one_company_per_ticker
from quantloom.sources.tables import add_load_timestamp

# Company columns shown next to a prediction.
COMPANY_COLUMNS = (
    "name", "sector", "industry", "sicSector", "location", "statementLastUpdated",
)


def relevant_preds(
    predictions: DataFrame, meta: DataFrame, one_company: bool = True,
) -> DataFrame:
    """Predictions of the latest training run for active companies.

    The run is picked by a scalar subquery on ``trained_date``: a table
    partitioned by that column is pruned to one partition.
    """
    companies = meta.where(F.col("isActive"))
    if one_company:
        companies = one_company_per_ticker(companies)
    companies = companies.select(F.upper("ticker").alias("_upper"), *COMPANY_COLUMNS)
    latest = latest_only(predictions, "trained_date")
    return latest.join(companies, latest["ticker"] == companies["_upper"], "inner").drop("_upper")


# What a prediction has once, whatever the number of its features.
HORIZON_COLUMNS = (
    "date", "ticker", "predicted_value_log", "actual_value_log", "predicted_value", "predicted_std",
    "actual_value", "pred_col", "trained_at", "trained_date",
)


def relevant_horizons(
    predictions: DataFrame, meta: DataFrame, one_company: bool = True,
) -> DataFrame:
    """``relevant_preds`` without the features: reduced to one row per prediction before any join."""
    columns = [c for c in HORIZON_COLUMNS if c in predictions.columns]
    return relevant_preds(predictions.select(*columns).distinct(), meta, one_company)


def _horizon_rows(preds: DataFrame) -> DataFrame:
    return preds.select(
        "ticker", horizon_label("pred_col").alias("pred_horizon"), "predicted_value",
        "predicted_std", *COMPANY_COLUMNS, F.col("date").alias("pred_date"), "trained_date",
        "pred_col",
    ).distinct()


def preds_per_horizon(preds: DataFrame) -> DataFrame:
    """One row per ticker and horizon, in that order."""
    return _horizon_rows(preds).orderBy(F.col("ticker").asc_nulls_last(), F.col("pred_horizon").asc_nulls_last())


def top_features(preds: DataFrame, key: str, pred_col: str) -> DataFrame:
    """What drives one prediction, the largest contribution first."""
    rows = preds.where((F.col("ticker") == key) & (F.col("pred_col") == pred_col))
    return by_magnitude(rows.select("feature", "shap_value", "feature_value"), "shap_value")


def forecasts(preds: DataFrame, keys: Sequence[str], jitter_days: int | None = None) -> DataFrame:
    """Forecast date, value and band of the chosen tickers; ``jitter_days`` spreads the dates."""
    rows = include_keys(preds, "ticker", keys)
    double, low, high = sigma_band("predicted_value", "predicted_std")
    out = (
        rows.select(
            "ticker", "trained_date",
            forecast_date("trained_date", horizon_months("pred_col")).alias("forecast_date"),
            "pred_col", "predicted_value", "predicted_std",
            "name", "sector", "industry", "sicSector", "location",
        )
        .distinct()
        .withColumns({"predicted_std_2": double, "band_low": low, "band_high": high})
    )
    if jitter_days is not None:
        out = out.withColumn(
            "jittered_date",
            jittered("forecast_date", "ticker", "pred_col", "trained_date", days=jitter_days),
        )
    return out


def stock_picker(
    preds: DataFrame, facets: Mapping[str, Sequence], ranges: Mapping[str, tuple] | None = None,
    positions: Sequence[int] | None = None, order: Sequence[Key | Column | str] = (),
) -> DataFrame:
    """Screens predictions by horizon, sector, industry and value; may pick listed rows."""
    if positions is None:
        return facet_filter(preds_per_horizon(preds), facets, ranges)
    order = list(order) or ["ticker", "pred_horizon", "pred_date"]
    return pick_rows(facet_filter(_horizon_rows(preds), facets, ranges), order, positions)


def relative_performance(
    prices: DataFrame, keys: Sequence[str], start: str, end: str, value: str = "adjClose",
    order: str | None = None,
) -> DataFrame:
    """Value of each day relative to the ticker's first day in the range."""
    rows = date_selection(prices, "ticker", "date", keys, start, end)
    daily = first_per_group(rows, ["ticker", "date"], value, order or value, f"first_{value}")
    return relative_to_first(daily, f"first_{value}", "ticker", "date")


def price_summary(
    prices: DataFrame, keys: Sequence[str], start: str, end: str, value: str = "adjClose",
) -> DataFrame:
    return series_summary(
        date_selection(prices, "ticker", "date", keys, start, end), "ticker", "date", value,
    )


def first_last_extract(
    prices: DataFrame, key: str, day: str, order: Sequence[str] = ("date",),
) -> DataFrame:
    """The key's first row and its last row of one day, stamped with the load time."""
    series = prices.where(F.col("ticker") == key)
    first = head_rows(series, [F.col(c).asc_nulls_last() for c in order], 1)
    last = tail_rows(lookup_day(series, "date", day), [F.col(c).desc() for c in order], 1)
    return add_load_timestamp(union_all([first, last]))
