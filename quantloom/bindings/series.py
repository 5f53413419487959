"""Bound queries: windowed operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.bindings.registry import bind, rounded, table
from quantloom.functions import macros
from quantloom.operators import windows
from quantloom.operators.joins import join_calendar

_W = "(partition by ticker order by date rows between {n} preceding and current row)"
_RN = "row_number() over (partition by ticker order by date)"
PRICES = {"max_group_rows": None}  # one row per ticker and calendar day


@bind("sma", "E1", f"""
    select ticker, date, round(case when {_RN} > 250 then avg(adjClose) over {_W.format(n=250)} end, 3)
      as sma from stock_prices""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    out = windows.with_sma(rows, "adjClose", "ticker", "date", 250, "sma", **PRICES)
    return rounded(out, 3, "sma").drop("adjClose")


@bind("sma_macro", "E1", f"""
    select ticker, date, round(case when {_RN} > 20 then avg(adjClose) over {_W.format(n=20)} end, 3)
      as sma from stock_prices""")
def _(spark, d):
    return rounded(table(spark, d, "stock_prices").select(
        "ticker", "date", macros.sma("adjClose", "ticker", "date", 20).alias("sma"),
    ), 3, "sma")


_EVENT_SMA = """
    select event_id, user_id, round(case when row_number() over w > 6 then avg(value) over f end, 3) as sma,
      round(case when row_number() over w > 6 then stddev_samp(value) over f end, 3) as dev
    from events window w as (partition by user_id order by ts, event_id),
      f as (partition by user_id order by ts, event_id rows between 6 preceding and current row)"""


def _event_moments(spark, d, **options):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = windows.rolling_moments(
        rows, "user_id", "ts", [windows.Rolling(6, {"sma": "value"}, {"dev": "value"})],
        tie_break=["event_id"], **options,
    )
    return rounded(out, 3, "sma", "dev").drop("ts", "value")


@bind("rolling_moments", "E1 E2", _EVENT_SMA)
def _(spark, d):
    return _event_moments(spark, d)


@bind("rolling_moments_hot_keys", "E1 E2", _EVENT_SMA)
def _(spark, d):
    """The same windows when almost every key counts as hot and is cut into blocks."""
    return _event_moments(spark, d, max_group_rows=16)


_RATIO = """select s.ticker, s.date, s.adjClose, s.adjVolume, m.adjClose as index_price
    from stock_prices s join market_prices m using (date)"""


def _with_index(spark, d):
    days = table(spark, d, "market_prices").select("date", F.col("adjClose").alias("index_price"))
    return join_calendar(
        table(spark, d, "stock_prices").select("ticker", "date", "adjClose", "adjVolume"), days, "date",
    )


@bind("index_volatility", "E2 C3", f"""
    select ticker, date, round(case when {_RN} > 250
      then stddev_samp(adjClose / index_price) over {_W.format(n=250)} end, 4) as volatility
    from ({_RATIO})""")
def _(spark, d):
    out = windows.with_index_volatility(
        _with_index(spark, d), "adjClose", "index_price", "ticker", "date", 250, "volatility", **PRICES,
    )
    return rounded(out, 4, "volatility").select("ticker", "date", "volatility")


@bind("volume_volatility", "E5", f"""
    select ticker, date,
      round(case when {_RN} > 250 then avg(adjVolume) over {_W.format(n=250)} end, 3) as mean_volume,
      round(stddev_samp(adjVolume) over {_W.format(n=250)}
        / nullif(case when {_RN} > 250 then avg(adjVolume) over {_W.format(n=250)} end, 0), 4) as volatility
    from stock_prices""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjVolume")
    out = windows.with_volume_volatility(
        rows, "adjVolume", "ticker", "date", 250, "mean_volume", "volatility", **PRICES,
    )
    return rounded(rounded(out, 3, "mean_volume"), 4, "volatility").drop("adjVolume")


@bind("margin_stability", "E6", f"""
    select ticker, date, round(stddev_samp(adjVolume) over {_W.format(n=4)}, 3) as stability
    from stock_prices""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjVolume")
    out = windows.with_short_deviation(rows, "adjVolume", "ticker", "date", 4, "stability", **PRICES)
    return rounded(out, 3, "stability").drop("adjVolume")


@bind("dedupe_latest", "E3", """
    select * from supported
    qualify row_number() over (partition by ticker order by endDate desc, note) = 1""")
def _(spark, d):
    return windows.dedupe_latest(
        table(spark, d, "supported"), ["ticker"], [F.col("endDate").desc(), F.col("note").asc()],
    )


@bind("first_in_period", "E4", """
    select ticker, date, adjClose from stock_prices
    qualify row_number() over (partition by ticker, year(date), quarter(date) order by date) = 1""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    return windows.first_in_period(rows, "ticker", "date")


@bind("future_return", "E7", """
    select ticker, date, round(lead(adjClose, 4) over (partition by ticker order by date)
      / nullif(adjClose, 0), 4) as ahead from stock_prices""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    out = windows.with_future_return(rows, "adjClose", "ticker", "date", 4, "ahead", **PRICES)
    return rounded(out, 4, "ahead").drop("adjClose")


@bind("future_return_hot_keys", "E7", """
    select event_id, user_id, round(lead(value, 3) over (partition by user_id order by ts, event_id)
      / nullif(value, 0), 4) as ahead from events""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = windows.with_future_return(
        rows, "value", "user_id", "ts", 3, "ahead", tie_break=["event_id"], max_group_rows=16,
    )
    return rounded(out, 4, "ahead").select("event_id", "user_id", "ahead")


_DEVELOPMENT = """
    select ticker, date, round(nullif((adjClose / lag(adjClose) over (partition by ticker order by date))
      / (index_price / lag(index_price) over ({over})), 0), 4) as development from ({ratio})"""


@bind("relative_development", "E8", _DEVELOPMENT.format(over="partition by ticker order by date", ratio=_RATIO))
def _(spark, d):
    out = windows.with_relative_development(
        _with_index(spark, d), "adjClose", "index_price", "ticker", "date", "development", **PRICES,
    )
    return rounded(out, 4, "development").select("ticker", "date", "development")


@bind("relative_development_global", "E8", _DEVELOPMENT.format(over="order by date, ticker", ratio=_RATIO))
def _(spark, d):
    out = windows.with_relative_development(
        _with_index(spark, d), "adjClose", "index_price", "ticker", "date", "development",
        index_lag="global", **PRICES,
    )
    return rounded(out, 4, "development").select("ticker", "date", "development")


@bind("relative_to_first", "E9", """
    select ticker, date, round(adjClose / first_value(adjClose) over (partition by ticker order by date), 4)
      as relative from stock_prices""")
def _(spark, d):
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    return rounded(windows.relative_to_first(rows, "adjClose", "ticker", "date"), 4, "relative").drop("adjClose")


@bind("latest_per_key", "E10", """
    select event_id, user_id, ts, event_type, value from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def _(spark, d):
    return windows.latest_per_key(
        table(spark, d, "events").drop("props"), "user_id", "ts", [F.col("event_id").desc()],
    )


@bind("row_index", "E11", """
    select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) - 1 as index from orders""")
def _(spark, d):
    from quantloom.operators.ordering import with_row_index

    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return with_row_index(o, ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


_ODD = "case when event_id % 97 = 0 then 'nan'::double when event_id % 89 = 0 then 1e17 else value end"


def _odd_frame(n: int) -> str:
    frame = f"(partition by user_id order by ts, event_id rows between {n} preceding and current row)"
    return f"""case when row_number() over (partition by user_id order by ts, event_id) <= {n} then null
        when count(*) filter (isnan(x)) over {frame} > 0 then -1.0
        when max(x) filter (not isnan(x)) over {frame} > 1e9 then -2.0
        else round(avg(case when isnan(x) then null else x end) over {frame}, 6) end as m{n}"""


@bind("rolling_moments_extremes", "E1 E2", f"""
    with odd as (select event_id, user_id, ts, {_ODD} as x from events)
    select event_id, {_odd_frame(4)}, {_odd_frame(11)} from odd""")
def _(spark, d):
    """NaN and outliers leave a frame together with their rows, for two frame lengths at once and with cut keys."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    key = F.col("event_id")
    odd = F.when(key % 97 == 0, F.lit(float("nan"))).when(key % 89 == 0, 1e17).otherwise(F.col("value"))
    frames = [windows.Rolling(n, means={f"m{n}": "x"}) for n in (4, 11)]
    out = windows.rolling_moments(events.withColumn("x", odd), "user_id", "ts", frames, ["event_id"], max_group_rows=200)
    shown = lambda m: F.when(F.isnan(m), -1.0).when(F.abs(F.col(m)) > 1e9, -2.0).otherwise(F.round(m, 6))
    return out.select("event_id", *[F.when(F.col(m).isNotNull(), shown(m)).alias(m) for m in ("m4", "m11")])
