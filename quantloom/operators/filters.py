"""Row and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exchanges of the universe.
US_EXCHANGES = ("NYSE", "NASDAQ", "NYSE MKT", "NYSE ARCA", "AMEX")
# From when on NASDAQ rows train the models; when to sample a quarter.
NASDAQ_TRAINING_START = "2002-10-01"
SAMPLE_MONTHS = (2, 5, 8, 11)
SAMPLE_MIN_DAY = 17


def filter_universe(tickers: DataFrame, exchanges: Sequence[str] = US_EXCHANGES) -> DataFrame:
    """Listed stocks, and funds that still trade on the feed's last day."""
    last_day = tickers.agg(F.max("endDate")).scalar()
    alive = (F.col("assetType") == "ETF") & (F.col("endDate") == last_day)
    return tickers.where(
        F.col("exchange").isin(*exchanges)
        & F.col("startDate").isNotNull()
        & ((F.col("assetType") == "Stock") | alive),
    )


def exclude_keys(df: DataFrame, key: str, excluded: Sequence[str] | DataFrame) -> DataFrame:
    """Drops keys on a list, ignoring case.  Null keys stay."""
    if isinstance(excluded, DataFrame):
        names = excluded.select(F.upper(F.col(excluded.columns[0])).alias("_x")).distinct()
        return df.join(names, F.upper(df[key]) == names["_x"], "left_anti")
    names = sorted({e.upper() for e in excluded})
    if not names:
        return df
    return df.where(F.col(key).isNull() | ~F.upper(F.col(key)).isin(names))


def include_keys(df: DataFrame, key: str, included: Sequence[str]) -> DataFrame:
    """Keeps listed keys, ignoring case, and upper-cases them."""
    names = sorted({i.upper() for i in included})
    return df.withColumn(key, F.upper(key)).where(F.col(key).isin(names))


def skip_existing(df: DataFrame, key: str, target: DataFrame, target_key: str | None = None) -> DataFrame:
    """Drops keys that the target table already holds, ignoring case."""
    return exclude_keys(df, key, target.select(target_key or key))


def lookback(df: DataFrame, time: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days; zero switches the filter off."""
    if days <= 0:
        return df
    as_of = F.current_date() if as_of is None else as_of
    return df.where(F.col(time) >= F.date_sub(as_of, days))


def corporate_actions(df: DataFrame, split: str = "splitFactor", cash: str = "divCash") -> DataFrame:
    """Rows with a split or a dividend."""
    return df.where((F.col(split) != 1.0) | (F.col(cash) > 0))


def date_selection(
    df: DataFrame, key: str, time: str, keys: Sequence[str], start: str, end: str,
) -> DataFrame:
    """Listed keys within an inclusive date range."""
    return df.where(
        F.col(key).isin(list(keys))
        & F.col(time).between(F.lit(start).cast("date"), F.lit(end).cast("date")),
    )


def training_members(universe: DataFrame, strict: bool = False) -> DataFrame:
    """Tickers that ``training_universe`` may keep on some date."""
    stock = F.col("assetType") == "Stock"
    nyse, nasdaq = F.col("exchange") == "NYSE", F.col("exchange") == "NASDAQ"
    return universe.where(stock & (nyse | nasdaq) if strict else (stock & nyse) | nasdaq)


def training_universe(
    df: DataFrame, time: str = "date", nasdaq_from: str = NASDAQ_TRAINING_START,
    strict: bool = False,
) -> DataFrame:
    """NYSE stocks, and NASDAQ rows from a date on.

    By default NASDAQ funds pass as well, because the stock condition binds to
    NYSE alone; ``strict`` applies it to both exchanges.
    """
    stock = F.col("assetType") == "Stock"
    nyse = F.col("exchange") == "NYSE"
    nasdaq = (F.col("exchange") == "NASDAQ") & (F.col(time) >= F.lit(nasdaq_from).cast("date"))
    return df.where(stock & (nyse | nasdaq) if strict else (stock & nyse) | nasdaq)


def calendar_filter(
    df: DataFrame, time: str = "date", min_day: int = SAMPLE_MIN_DAY,
    months: Sequence[int] = SAMPLE_MONTHS,
) -> DataFrame:
    return df.where((F.dayofmonth(time) >= min_day) & F.month(time).isin(list(months)))


def drop_annual(df: DataFrame, quarter: str = "quarter") -> DataFrame:
    return df.where(F.col(quarter) != 0)


def facet_filter(
    df: DataFrame, facets: Mapping[str, Sequence], ranges: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """All memberships and inclusive ranges at once; an empty facet selects everything."""
    tests = [F.col(c).isin(list(v)) for c, v in facets.items() if len(v) > 0]
    tests += [F.col(c).between(low, high) for c, (low, high) in (ranges or {}).items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def select_except(df: DataFrame, columns: Sequence[str], missing_ok: bool = False) -> DataFrame:
    """All columns but these; an unknown name is an error unless ``missing_ok``."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown and not missing_ok:
        raise ValueError(f"columns to exclude are missing: {unknown}")
    return df.drop(*columns)


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def normalise_types(df: DataFrame) -> DataFrame:
    """Decimals to double, missing strings to the text ``None``."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit("None"))
        out.append(c.alias(f.name))
    return df.select(*out)


def since(df: DataFrame, time: str, day: str, inclusive: bool = True) -> DataFrame:
    """Rows from a date on (attributions) or after it (prediction history)."""
    day = F.lit(day).cast("date")
    return df.where(F.col(time) >= day if inclusive else F.col(time) > day)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raises when ``df`` is empty (looks at one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def lookup_day(df: DataFrame, time: str, day: str, key: str | None = None, value: str | None = None) -> DataFrame:
    out = df.where(F.col(time) == F.lit(day).cast("date"))
    return out if key is None else out.where(F.col(key) == value)


def latest_only(df: DataFrame, time: str) -> DataFrame:
    """Rows that carry the table's largest ``time``, as a pushed-down scalar filter."""
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())
