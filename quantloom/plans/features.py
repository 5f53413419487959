"""The feature chain: wide statements, ratios and forward excess returns.

One shuffle by ticker carries every price window; the calendar-sized index
side is broadcast, so it does not disturb that layout.  Daily inputs hold one
row per ticker and DATE, which bounds a ticker's rows by the calendar, so the
ticker windows need no hot-key handling (``max_group_rows=None``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.scalars import (
    company_ratios,
    excess_return,
    metric_name,
    release_date,
    safe_divide,
)
from quantloom.operators.filters import (
    NASDAQ_TRAINING_START,
    SAMPLE_MIN_DAY,
    SAMPLE_MONTHS,
    calendar_filter,
    drop_annual,
    training_members,
    training_universe,
)
from quantloom.operators.joins import asof_join, inner_join, join_calendar, left_join, left_join_upper
from quantloom.operators.reshape import pivot_multi, pivot_sum
from quantloom.operators.windows import (
    Rolling,
    dedupe_latest,
    first_in_period,
    rolling_moments,
    with_future_returns,
    with_relative_developments,
    with_short_deviation,
)

# Moving-average lengths in trading days, forward horizons in quarters.
PERIODS = {"12m": 250, "36m": 750}
HORIZONS = {"6m": 2, "12m": 4, "24m": 8, "36m": 12}
INDEX = "SPY"

# Price rows of one task: the windows of both chains keep about ten sorted copies of them in memory.
PART_ROWS = 250_000

# Columns that do not describe a company to a model.
STATEMENT_EXCLUDED = (
    "close", "fiscal_date", "safe_release_date", "permaTicker", "sicCode", "companyWebsite",
    "secFilingWebsite", "statementLastUpdated", "dailyLastUpdated", "isActive",
)

# Columns left out of the training table.
TRAINING_EXCLUDED = (
    "balanceSheet_sharesBasic", "overview_shareFactor", "balanceSheet_deferredRev",
    "balanceSheet_taxLiabilities", "balanceSheet_acctPay", "balanceSheet_deposits",
    "incomeStatement_eps", "incomeStatement_shareswa", "incomeStatement_shareswaDil",
    "incomeStatement_netinc", "isADR", "balanceSheet_totalAssets", "balanceSheet_taxAssets",
    "incomeStatement_netIncDiscOps", "incomeStatement_prefDVDs",
    "incomeStatement_nonControllingInterests", "incomeStatement_ebt",
    "balanceSheet_assetsCurrent", "cashFlow_ncfx", "cashFlow_businessAcqDisposals",
    "balanceSheet_investmentsCurrent", "incomeStatement_consolidatedIncome", "marketCap",
    "balanceSheet_accoci", "reportingCurrency", "adjVolume", "overview_piotroskiFScore",
    "cashFlow_ncf", "cashFlow_ncff", "cashFlow_capex", "cashFlow_issrepayDebt",
    "balanceSheet_liabilitiesNonCurrent", "incomeStatement_costRev", "incomeStatement_ebit",
    "incomeStatement_intexp", "cashFlow_ncfo", "cashFlow_ncfi", "trailingPEG1Y",
)


def price_parts(prices: DataFrame) -> int:
    """Parts for the price windows, so that a task's memory does not grow with the table (counts its rows)."""
    cores = prices.sparkSession.sparkContext.defaultParallelism
    return max(cores, ceil(prices.count() / PART_ROWS))


def price_averages(prices: DataFrame, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """Moving averages over the full price history of each ticker."""
    frames = [Rolling(n, means={f"SMA_{label}": "adjClose"}) for label, n in periods.items()]
    return rolling_moments(prices, "ticker", "date", frames, max_group_rows=None)


def index_by_day(
    prices: DataFrame, indices: Sequence[str] = (INDEX,), periods: Mapping[str, int] = PERIODS,
) -> DataFrame:
    """One row per day with ``<index>_adjClose`` and ``<index>_SMA_*``.

    Index rows are filtered before the averages are taken: a few tickers
    instead of the whole table.
    """
    rows = price_averages(
        prices.where(F.col("ticker").isin(list(indices))).select("ticker", "date", "adjClose"),
        periods,
    )
    columns = ["adjClose", *[f"SMA_{label}" for label in periods]]
    return pivot_multi(rows, "ticker", list(indices), ["date"], columns, order="date")


def sampled_prices(
    prices: DataFrame,
    universe: DataFrame,
    indices: Sequence[str] = (INDEX,),
    periods: Mapping[str, int] = PERIODS,
    nasdaq_from: str = NASDAQ_TRAINING_START,
    strict: bool = False,
    min_day: int = SAMPLE_MIN_DAY,
    months: Sequence[int] = SAMPLE_MONTHS,
    parts: int | None = None,
) -> DataFrame:
    """Price metrics on one day per ticker and quarter.

    Averages see the full history; volatility and volume metrics see the
    history that remains after the universe and index-day filters.  ``parts``
    fixes the number of tasks of the one shuffle by ticker (``price_parts``),
    which AQE would merge by bytes sent, though a task needs many times those
    as memory; leave it out for prices that lie by ticker already.
    """
    if not isinstance(prices.schema["date"].dataType, T.DateType):
        raise ValueError("prices must hold one row per ticker and DATE")
    prices = prices.select(
        "ticker", "date", "close", F.col("adjClose").cast("double").alias("adjClose"),
        F.col("adjVolume").cast("double").alias("adjVolume"),
    )
    # Whole tickers that can never train leave before the windows, not after them.
    members = training_members(universe.select("ticker", "exchange", "assetType"), strict)
    dealt = prices.repartition(parts, "ticker") if parts else prices
    histories = price_averages(inner_join(dealt, members, ["ticker"]), periods)
    subset = training_universe(histories, nasdaq_from=nasdaq_from, strict=strict).drop("assetType")
    out = join_calendar(subset, index_by_day(prices, indices, periods), "date")
    out = out.withColumn("_ratio", safe_divide("adjClose", f"{indices[0]}_adjClose"))
    first = next(iter(periods))
    frames = [
        Rolling(
            n,
            means={f"SMA_volume_{label}": "adjVolume"} if label == first else {},
            deviations={f"volatility_{label}": "_ratio"}
            | ({"_dev": "adjVolume"} if label == first else {}),
        )
        for label, n in periods.items()
    ]
    out = rolling_moments(out, "ticker", "date", frames, max_group_rows=None)
    sampled = first_in_period(calendar_filter(out, "date", min_day, months), "ticker", "date")
    volatility = safe_divide("_dev", f"SMA_volume_{first}")
    return sampled.withColumn(f"volume_volatility_{first}", volatility).drop("_ratio", "_dev")


def pivoted_statements(
    statements: DataFrame, metrics: Sequence[str] | None = None,
) -> DataFrame:
    """Quarterly statements, one column per metric, with their release date."""
    rows = drop_annual(statements).select(
        "ticker", F.col("date").alias("fiscal_date"),
        metric_name("statementType", "dataCode").alias("metrics"),
        F.col("value").cast("double").alias("value"),
    )
    wide = pivot_sum(rows, "metrics", "value", ["ticker", "fiscal_date"], metrics)
    return wide.withColumn("safe_release_date", release_date("fiscal_date"))


def one_company_per_ticker(meta: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Active and most recently updated company of each ticker, ignoring case."""
    keyed = meta.withColumn("_upper", F.upper("ticker"))
    order = [
        F.col("isActive").desc(), F.col("statementLastUpdated").desc(),
        F.col("permaTicker").asc(), *tie_break,
    ]
    return dedupe_latest(keyed, ["_upper"], order).drop("_upper")


def wide_statements(
    prices: DataFrame, universe: DataFrame, statements: DataFrame, meta: DataFrame,
    metrics: Sequence[str] | None = None, **options,
) -> DataFrame:
    """One row per ticker and quarter: price metrics with the latest public statement."""
    described = left_join_upper(
        pivoted_statements(statements, metrics), one_company_per_ticker(meta), "ticker", "ticker",
    )
    wide = asof_join(
        sampled_prices(prices, universe, **options), described, ["ticker"], "date",
        "safe_release_date", max_group_rows=None,
    )
    return wide.drop(*STATEMENT_EXCLUDED)


def wide_with_daily_fundamentals(
    wide: DataFrame, daily: DataFrame, min_day: int = SAMPLE_MIN_DAY,
    months: Sequence[int] = SAMPLE_MONTHS,
) -> DataFrame:
    """Adds the daily ratios of the sampled day.

    Wide rows fall on sampled days only, so the daily table is cut to those
    days before it is shuffled; the left join's result is the same.
    """
    return left_join(wide, calendar_filter(daily, "date", min_day, months), ["ticker", "date"])


def wide_with_combined_metrics(wide: DataFrame) -> DataFrame:
    """Adds ratios, and the stability of the gross margin over five quarters."""
    out = with_short_deviation(
        wide, "overview_grossMargin", "ticker", "date", 4, "margin_stability", max_group_rows=None,
    )
    return out.withColumns(company_ratios())


def excess_returns(
    wide: DataFrame,
    index: str = INDEX,
    periods: Mapping[str, int] = PERIODS,
    horizons: Mapping[str, int] = HORIZONS,
    index_lag: str = "key",
    excluded: Sequence[str] = TRAINING_EXCLUDED,
) -> DataFrame:
    """The training table: log returns beyond the index for each horizon.

    Rows are quarters of a ticker, so every window holds a few hundred rows.
    """
    market = f"{index}_adjClose"
    returns = {}
    for label, n in horizons.items():
        returns[f"adjClose_return_{label}"] = ("adjClose", n)
        returns[f"{index}_return_{label}"] = (market, n)
    out = with_future_returns(wide, "ticker", "date", returns, max_group_rows=None)
    out = out.withColumns({
        f"excess_return_ln_{label}": excess_return(
            f"adjClose_return_{label}", f"{index}_return_{label}",
        )
        for label in horizons
    })
    averages = [name for label in periods for name in (f"SMA_{label}", f"{index}_SMA_{label}")]
    out = with_relative_developments(
        out, "ticker", "date",
        {f"relative_sma_development_{p}": (f"SMA_{p}", f"{index}_SMA_{p}") for p in periods},
        index_lag=index_lag, max_group_rows=None,
    )
    used = [*returns, *averages]
    return out.drop("adjClose", f"{index}_adjClose", *used, *excluded)


def training_table(
    prices: DataFrame, universe: DataFrame, statements: DataFrame, daily: DataFrame,
    meta: DataFrame, metrics: Sequence[str] | None = None,
    periods: Mapping[str, int] = PERIODS, horizons: Mapping[str, int] = HORIZONS,
    index_lag: str = "key", **options,
) -> DataFrame:
    """The whole chain, lazily; write or cache it once before training several models."""
    wide = wide_statements(
        prices, universe, statements, meta, metrics, periods=periods, **options,
    )
    wide = wide_with_combined_metrics(wide_with_daily_fundamentals(wide, daily))
    return excess_returns(wide, periods=periods, horizons=horizons, index_lag=index_lag)
