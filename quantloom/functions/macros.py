"""The five windowed macros as functions that return a ``Column``.

They frame rows of one key in time order.  On a panel with one row per key and
calendar day the group is bounded by the calendar; where a key can hold an
unbounded number of rows use ``operators.windows``, which splits such keys.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.functions.scalars import ColumnLike, _col, excess_return, safe_divide

__all__ = [
    "sma", "index_volatility", "future_return", "excess_return",
    "relative_sma_development", "rolling_std", "register_sql_functions",
]


def _ordered(key: str, time: str) -> WindowSpec:
    return W.partitionBy(key).orderBy(time)


def _after_warm_up(value: Column, key: str, time: str, periods: int) -> Column:
    return F.when(F.row_number().over(_ordered(key, time)) > periods, value)


def sma(value: ColumnLike, key: str, time: str, periods: int) -> Column:
    """Mean of the current and ``periods`` preceding rows, null during warm-up."""
    frame = _ordered(key, time).rowsBetween(-periods, 0)
    return _after_warm_up(F.avg(_col(value)).over(frame), key, time, periods)


def rolling_std(value: ColumnLike, key: str, time: str, periods: int) -> Column:
    """Sample deviation over the same frame, without warm-up."""
    return F.stddev_samp(_col(value)).over(_ordered(key, time).rowsBetween(-periods, 0))


def index_volatility(
    price: ColumnLike, index_price: ColumnLike, key: str, time: str, periods: int,
) -> Column:
    """Sample deviation of price over index, null during warm-up."""
    ratio = safe_divide(price, index_price)
    return _after_warm_up(rolling_std(ratio, key, time, periods), key, time, periods)


def future_return(price: ColumnLike, key: str, time: str, periods: int) -> Column:
    """Price ``periods`` rows ahead over the current price."""
    return safe_divide(F.lead(_col(price), periods).over(_ordered(key, time)), price)


def relative_sma_development(
    stock_sma: ColumnLike, index_sma: ColumnLike, key: str, time: str,
) -> Column:
    """Growth of the stock's average since its last row, over that of the index."""
    spec = _ordered(key, time)
    stock, index = _col(stock_sma), _col(index_sma)
    stock_growth = safe_divide(stock, F.lag(stock, 1).over(spec))
    index_growth = safe_divide(index, F.lag(index, 1).over(spec))
    return F.nullif(safe_divide(stock_growth, index_growth), F.lit(0))


def register_sql_functions(spark: SparkSession) -> None:
    """Makes ``excess_return(stock, index)`` callable from SQL.

    The other macros are windowed, which SQL functions may not be.
    """
    spark.sql(
        "create or replace temporary function excess_return(stock double, idx double) "
        "returns double return "
        "case when idx > 0 and stock > 0 then ln(nullif(stock / idx, 0)) end",
    )
