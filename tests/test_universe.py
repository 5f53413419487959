from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from quantloom import schemas
from quantloom.operators.filters import corporate_actions
from quantloom.plans import refresh, universe

D = dt.date.fromisoformat


def _tickers(spark, data):
    filled = [
        (t, e, a, "USD", D(s) if s else None, D(x) if x else None) for t, e, a, s, x in data
    ]
    return spark.createDataFrame(filled, schemas.SUPPORTED_TICKERS_DDL)


def test_universe_view(spark):
    df = _tickers(spark, [
        ("QLM", "NYSE", "Stock", "2011-02-03", "2019-07-03"),  # listed and trading
        ("GONE", "AMEX", "Stock", "1996-05-06", "2008-10-10"),  # a stock that no longer trades stays
        ("NOSTART", "NYSE", "Stock", None, "2019-07-03"),
        ("BLANK", "NYSE", "Stock", None, None),
        ("FUNDX", "NYSE ARCA", "ETF", "2004-04-05", "2012-02-02"),  # a fund that no longer trades goes
        ("MOVED", "NYSE ARCA", "ETF", "2006-01-03", "2018-12-31"),
        ("MOVED", "NASDAQ", "ETF", "2006-01-03", "2019-07-03"),  # the listing that traded last
        ("FRGN", "LSE", "Stock", "2001-12-12", "2019-07-03"),
    ])
    assert rows(universe.selected_us_tickers(df), "ticker", "exchange") == [
        ("GONE", "AMEX"), ("MOVED", "NASDAQ"), ("QLM", "NYSE"),
    ]


FEED = [
    ("qlm", "NYSE", "Stock", "2011-02-03", "2019-07-03"),
    ("VLT", "NASDAQ", "Stock", "1999-09-09", "2019-07-03"),
    ("GONE", "AMEX", "Stock", "1996-05-06", "2008-10-10"),
    ("FRGN", "LSE", "Stock", "2001-12-12", "2019-07-03"),
    ("FUNDA", "NYSE MKT", "ETF", "2013-03-14", "2019-07-03"),
    ("FUNDX", "NYSE ARCA", "ETF", "2004-04-05", "2012-02-02"),
    ("SPLT", "NASDAQ", "Stock", "2015-09-17", "2019-07-03"),
    ("DVD", "AMEX", "Stock", "2003-03-31", "2019-07-03"),
]


def _snapshot(spark):
    def row(ticker, close, cash, split):
        return (ticker, "2019-07-03", close, 700, cash, split)

    data = [row("qlm", 41.25, 0.0, 1.0), row("vlt", 12.0, 0.0, 1.0), row("splt", 7.5, 0.0, 0.5),
            row("DVD", 88.0, 0.35, 1.0)]
    df = spark.createDataFrame(data, "ticker string, day string, c double, v bigint, cash double, s double")
    money = {n: F.col("c").cast("decimal(18,3)") for n in
             ("close", "high", "low", "open", "adjClose", "adjHigh", "adjLow", "adjOpen")}
    return df.withColumns(money).select(
        "ticker", F.col("day").cast("date").alias("date"), "close", "high", "low", "open",
        F.col("v").alias("volume"), "adjClose", "adjHigh", "adjLow", "adjOpen", F.col("v").alias("adjVolume"),
        F.col("cash").cast("decimal(18,3)").alias("divCash"), F.col("s").cast("decimal(18,3)").alias("splitFactor"),
    )


def _old_prices(spark):
    data = [(D(d), p, p, v, t) for d, p, v, t in [
        ("2019-07-01", 40, 650, "QLM"), ("2019-07-01", 11, 300, "VLT"), ("2019-07-01", 5, 20, "OTHER"),
        ("2019-07-02", 41, 640, "QLM"), ("2019-07-02", 12, 310, "VLT"), ("2019-07-02", 6, 25, "OTHER"),
    ]]
    return spark.createDataFrame(data, "date date, close int, adjClose int, adjVolume bigint, ticker string").select(
        "date", F.col("close").cast("decimal(18,3)"), F.col("adjClose").cast("decimal(18,3)"), "adjVolume", "ticker",
    )


def _history(spark, *tickers):
    days = {"DVD": ["2019-07-03", "2018-01-05", "2016-06-06"], "SPLT": ["2019-07-03", "2018-01-05", "2017-03-01"]}
    data = [(D(d), 33, 900, t) for t in tickers for d in days[t]]
    return spark.createDataFrame(data, "date date, c int, adjVolume bigint, ticker string").select(
        "date", F.col("c").cast("decimal(18,3)").alias("close"),
        F.col("c").cast("decimal(18,3)").alias("adjClose"), "adjVolume", "ticker",
    )


def test_daily_run(spark):
    done = refresh.daily_refresh(_tickers(spark, FEED), _snapshot(spark), _old_prices(spark))
    assert done.universe.count() == 6
    assert done.snapshot.count() == 4
    assert done.prices.count() == 10
    assert rows(done.restate) == [("DVD",), ("SPLT",)]
    restated, failed = refresh.restate_history(done.prices, done.restate, _history(spark, "DVD", "SPLT"))
    assert restated.count() == 14 and failed.count() == 0
    assert {r["adjClose"] for r in restated.where("ticker = 'SPLT'").collect()} == {33}


def test_failed_history_is_reported_and_others_continue(spark):
    done = refresh.daily_refresh(_tickers(spark, FEED), _snapshot(spark), _old_prices(spark))
    restated, failed = refresh.restate_history(done.prices, done.restate, _history(spark, "SPLT"))
    assert rows(failed) == [("DVD",)] and restated.count() == 12


def test_corporate_actions(spark):
    got = corporate_actions(universe.selected_last_trading_day(_snapshot(spark), _tickers(spark, FEED)))
    assert rows(got, "ticker") == [("DVD",), ("SPLT",)]


def _meta(spark, data):
    df = spark.createDataFrame(data, "permaTicker string, ticker string, isActive boolean, s string, d string")
    return df.select("permaTicker", "ticker", "isActive", F.col("s").cast("date").alias("statementLastUpdated"),
                     F.col("d").cast("date").alias("dailyLastUpdated"))


def test_null_filter_follows_dedupe(spark):
    meta = _meta(spark, [
        ("1", "qlm", True, "2019-01-01", None), ("2", "qlm", False, "2019-02-01", "2019-02-01"),
        ("3", "VLT", True, "2019-01-01", "2019-01-01"), ("4", "VLT", True, "2019-03-01", "2019-03-01"),
        ("5", "AWAY", True, "2019-01-01", "2019-01-01"),
    ])
    got = universe.selected_fundamentals(meta, _tickers(spark, FEED))
    assert rows(got, "permaTicker") == [("4",)]


def _companies(spark):
    return _meta(spark, [
        (t, t, True, "2019-06-01", d) for t, d in
        [("dvd", "2019-07-02"), ("qlm", "2019-07-02"), ("vlt", "2019-05-01")]
    ])


def _keys(spark, **options):
    return [r[0] for r in rows(universe.select_keys(_companies(spark), **options), "ticker")]


def test_key_selection(spark):
    assert _keys(spark, hour=8) == ["DVD"]
    assert _keys(spark, hour=21) == ["QLM", "VLT"]
    assert _keys(spark, skip=["qlm", "VLt", "none"]) == ["DVD"]
    existing = spark.createDataFrame([("DVD",), ("DVD",)], "ticker string")
    assert _keys(spark, existing=existing) == ["QLM", "VLT"]
    as_of = F.lit("2019-07-04").cast("date")
    assert _keys(spark, updated="dailyLastUpdated", lookback_days=5, as_of=as_of) == ["DVD", "QLM"]
    assert len(_keys(spark, sample=2)) == 2
    batched = universe.select_keys(_companies(spark), batch_size=2)
    assert rows(batched) == [("DVD", 0), ("QLM", 0), ("VLT", 1)]
    assert _keys(spark, skip=["DVD", "QLM", "VLT"]) == []


def test_given_keys_are_taken_as_they_are(spark):
    assert _keys(spark, tickers=["qlm", "NEWCO", "qlm"]) == ["NEWCO", "QLM"]
    assert _keys(spark, tickers=["qlm", "NEWCO", "dvd"], hour=2) == ["DVD"]
    assert _keys(spark, tickers=["newco"], skip=["NewCo"]) == []
