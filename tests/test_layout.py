"""Tables kept by key: the plans over them move nothing by that key."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from quantloom.plans import features
from quantloom.session import scratch_path
from quantloom.sources.tables import bucketed_table


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_price_chain_over_buckets(spark):
    day = F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") / 5).cast("int"))
    names = F.array(*map(F.lit, ["SPY", "AAA", "BBB", "CCC", "DDD"]))
    price = (F.col("id") % 97 + 3).cast("double")
    prices = spark.range(6000).select(
        F.get(names, (F.col("id") % 5).cast("int")).alias("ticker"), day.alias("date"),
        price.alias("close"), price.alias("adjClose"), (price * 10).alias("adjVolume"),
    )
    universe = spark.createDataFrame([(t, "NYSE", "Stock") for t in ("AAA", "BBB", "CCC", "SPY")], "ticker string, exchange string, assetType string")
    kept = bucketed_table(prices, "layout_prices", "ticker", ["date"], 4, scratch_path(spark, "layout"))
    plain, bucketed = (features.sampled_prices(p, universe) for p in (prices, kept))
    by_ticker = [[line for line in exchanges(df) if "hashpartitioning(ticker" in line] for df in (plain, bucketed)]
    # Only the short list of members still moves; the prices stay in their buckets.
    assert (len(by_ticker[0]), len(by_ticker[1])) == (2, 1), by_ticker
    assert rows(bucketed) == rows(plain) and bucketed.count() > 0


def test_parts_of_the_price_windows_follow_the_rows(spark, monkeypatch):
    days = spark.sql("select explode(sequence(date '2000-01-01', date '2001-12-31')) as date")
    tickers = spark.range(40).select(F.when(F.col("id") == 0, "SPY").otherwise(F.concat(F.lit("T"), "id")).alias("ticker"))
    prices = tickers.crossJoin(days).select("ticker", "date", *[(F.dayofyear("date") + F.length("ticker")).cast("double").alias(c) for c in ("close", "adjClose", "adjVolume")])
    universe = tickers.select("ticker", F.lit("NYSE").alias("exchange"), F.lit("Stock").alias("assetType"))
    monkeypatch.setattr(features, "PART_ROWS", 1000)
    assert features.price_parts(prices) == 30  # of 29,240 rows; AQE alone makes one task of them
    out = features.sampled_prices(prices, universe, periods={"12m": 5, "36m": 9}, parts=30)
    plain = features.sampled_prices(prices, universe, periods={"12m": 5, "36m": 9})
    assert sum("hashpartitioning(ticker" in line and ", 30)" in line for line in exchanges(out)) >= 1
    assert rows(out) == rows(plain) and out.count() > 0
    assert out.rdd.getNumPartitions() == 30
