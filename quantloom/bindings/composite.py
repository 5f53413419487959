"""Bound queries: the composite plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quantloom import schemas
from quantloom.bindings.registry import bind, table
from quantloom.bindings.standins import METRIC_NAMES
from quantloom.plans import features, predictions, refresh, universe
from quantloom.session import scratch_path
from quantloom.sources import versions
from quantloom.sources.tables import bucketed_table, full_refresh, upsert_partitions
from quantloom.streaming import landing

# ---- universe and refresh -------------------------------------------------------------------

_UNIVERSE = """universe as (
    select * from supported
    where exchange in ('NYSE', 'NASDAQ', 'NYSE MKT', 'NYSE ARCA', 'AMEX') and startDate is not null
      and (assetType = 'Stock' or (assetType = 'ETF' and endDate = (select max(endDate) from supported)))
    qualify row_number() over (partition by ticker order by endDate desc, note) = 1)"""

_SELECTED = """selected as (
    select date, close, adjClose, adjVolume, upper(ticker) as ticker, splitFactor, divCash
    from snapshot where lower(ticker) in (select lower(ticker) from universe)
    qualify row_number() over (partition by upper(ticker) order by divCash desc, adjClose desc) = 1)"""

_COMPANIES = """companies as (
    select * from (
      select * from meta where upper(ticker) in (select upper(ticker) from universe)
      qualify row_number() over (partition by ticker
        order by isActive desc, statementLastUpdated desc, permaTicker) = 1)
    where dailyLastUpdated is not null)"""


def _universe(spark, d):
    return universe.selected_us_tickers(table(spark, d, "supported"), [F.col("note").asc()])


def _selected(spark, d):
    return universe.selected_last_trading_day(
        table(spark, d, "snapshot"), _universe(spark, d), [F.col("adjClose").desc()],
    )


def _companies(spark, d):
    return universe.selected_fundamentals(
        table(spark, d, "meta"), _universe(spark, d), [F.col("permaTicker").asc()],
    )


@bind("selected_us_tickers", "K1", f"with {_UNIVERSE} select * from universe")
def _(spark, d):
    return _universe(spark, d)


@bind("selected_last_trading_day", "K2", f"with {_UNIVERSE}, {_SELECTED} select * from selected")
def _(spark, d):
    return _selected(spark, d)


@bind("selected_fundamentals", "K3", f"with {_UNIVERSE}, {_COMPANIES} select * from companies")
def _(spark, d):
    return _companies(spark, d)


@bind("select_keys", "K4", f"""
    with {_UNIVERSE}, {_COMPANIES}, recent as (
      select distinct ticker from companies where dailyLastUpdated >= date '2001-11-01' - 30),
    ranked as (select ticker, row_number() over (order by ticker) - 1 as i, count(*) over () as n from recent),
    wanted as (
      select upper(ticker) as ticker from ranked where i >= n // 2
        and upper(ticker) not in (select upper(ticker) from stock_prices where adjVolume > 250)
        and upper(ticker) not in ('T3', 'T98'))
    select ticker, (row_number() over (order by ticker) - 1) // 10 as batch from wanted""")
def _(spark, d):
    return universe.select_keys(
        _companies(spark, d), updated="dailyLastUpdated", lookback_days=30,
        as_of=F.lit("2001-11-01").cast("date"), hour=15,
        existing=table(spark, d, "stock_prices").where("adjVolume > 250"), skip=["t3", "T98"],
        batch_size=10,
    )


_OLD = "old as (select date, close, adjClose, adjVolume, ticker from stock_prices where date < date '2001-09-01')"
_REFRESHED = f"""{_UNIVERSE}, {_SELECTED}, {_OLD}, refreshed as (
    select date, close, adjClose, adjVolume, ticker from selected
    union all
    select * from old where (ticker, date) not in (select (ticker, date) from selected))"""


def _old_prices(spark, d):
    return table(spark, d, "stock_prices").where("date < date '2001-09-01'").select(
        "date", "close", "adjClose", "adjVolume", "ticker",
    )


def _refreshed(spark, d):
    supported = table(spark, d, "supported").drop("note")
    return refresh.daily_refresh(
        supported, table(spark, d, "snapshot"), _old_prices(spark, d), [F.col("adjClose").desc()],
    )


@bind("daily_refresh", "K5 A8 B7", f"with {_REFRESHED} select * from refreshed")
def _(spark, d):
    return _refreshed(spark, d).prices


@bind("keys_to_restate", "K5 B7", f"""
    with {_UNIVERSE}, {_SELECTED} select ticker from selected where splitFactor <> 1.0 or divCash > 0""")
def _(spark, d):
    return _refreshed(spark, d).restate


@bind("restate_history", "K6", f"""
    with {_UNIVERSE}, {_SELECTED}, {_OLD},
    acted as (select ticker from selected where splitFactor <> 1.0 or divCash > 0),
    history as (select date, close / 2 as close, adjClose / 2 as adjClose, adjVolume * 2 as adjVolume, ticker
      from stock_prices where ticker in (select ticker from acted))
    select * from history
    union all select * from old where (ticker, date) not in (select (ticker, date) from history)""")
def _(spark, d):
    halved = table(spark, d, "stock_prices").selectExpr(
        "date", "close / 2 close", "adjClose / 2 adjClose", "adjVolume * 2 adjVolume", "ticker",
    )
    restated, _ = refresh.restate_history(_old_prices(spark, d), _refreshed(spark, d).restate, halved)
    return restated


@bind("restate_failures", "K6", f"""
    with {_UNIVERSE}, {_SELECTED} select ticker from selected
    where (splitFactor <> 1.0 or divCash > 0)
      and ticker not in (select ticker from stock_prices where adjVolume > 240)""")
def _(spark, d):
    part = table(spark, d, "stock_prices").where("adjVolume > 240").select(
        "date", "close", "adjClose", "adjVolume", "ticker",
    )
    _, failed = refresh.restate_history(_old_prices(spark, d), _refreshed(spark, d).restate, part)
    return failed


_RATIO_DDL = (
    "date date, marketCap double, enterpriseVal double, peRatio double, pbRatio double, "
    "trailingPEG1Y double"
)


@bind("load_fundamentals", "K7", """
    select date, marketCap, enterpriseVal, peRatio, pbRatio, trailingPEG1Y, ticker from daily_ratios
    union all
    select date + 10000, marketCap, enterpriseVal, peRatio, pbRatio, trailingPEG1Y, ticker
    from daily_ratios where peRatio > 40""")
def _(spark, d):
    ratios = table(spark, d, "daily_ratios")
    columns = ["date", "marketCap", "enterpriseVal", "peRatio", "pbRatio", "trailingPEG1Y"]
    old = ratios.select(*columns, "ticker")
    kept = old.where("peRatio > 40").withColumn("date", F.date_add("date", 10000))
    stale = old.withColumn("marketCap", F.lit(-1.0))
    path = scratch_path(spark, "fundamentals")
    (
        old.unionByName(old).repartition("ticker").sortWithinPartitions("ticker", "date")
        .write.option("header", True).option("compression", "gzip").partitionBy("ticker").csv(path)
    )
    merged, _ = refresh.load_fundamentals(
        spark, path, kept.unionByName(stale), schemas.FUNDAMENTALS_DAILY_KEY, _RATIO_DDL,
        key_pattern="ticker=([^/]+)",
    )
    return merged


_META = [n.split()[0] for n in schemas.FUNDAMENTALS_META_DDL.split(", ")]


@bind("update_metadata", "K8", f"""
    select {', '.join(_META)} from meta where not isADR
    union all
    select {', '.join(_META)} from (select * replace (name || '*' as name) from meta where isADR)""")
def _(spark, d):
    meta = table(spark, d, "meta").select(*_META)
    path = scratch_path(spark, "meta")
    feed = meta.where("isADR").withColumn("name", F.concat("name", F.lit("*")))
    (
        feed.withColumn("dataProviderPermaTicker", F.lit("199059")).repartition("permaTicker")
        .write.option("header", True).option("escape", '"').csv(path)
    )
    merged, _ = refresh.update_metadata(spark, path, meta)
    return merged


# ---- the feature chain ----------------------------------------------------------------------

PERIODS = {"12m": 250, "36m": 400}  # a supplier has about 550 days
NASDAQ_FROM = "1998-10-01"
_W = "(partition by {p} order by date rows between {n} preceding and current row)"


def _sma(value: str, n: int, p: str = "ticker") -> str:
    window = _W.format(p=p, n=n)
    return f"""case when row_number() over (partition by {p} order by date) > {n}
      then avg({value}) over {window} end"""


def _volatility(n: int) -> str:
    return f"""case when row_number() over (partition by ticker order by date) > {n}
      then stddev_samp(adjClose / nullif(SPY_adjClose, 0)) over {_W.format(p='ticker', n=n)} end"""


_PIVOTED = ",\n".join(
    f"cast(sum(amount) filter (metric = '{m}') as double) as {m}" for m in METRIC_NAMES
)

_WIDE = f"""averages as (
    select *, {_sma('adjClose', 250)} as SMA_12m, {_sma('adjClose', 400)} as SMA_36m from prices),
  market as (
    select date, adjClose as SPY_adjClose, SMA_12m as SPY_SMA_12m, SMA_36m as SPY_SMA_36m
    from averages where ticker = 'SPY'),
  chosen as (
    select a.*, m.exchange from averages a join members m using (ticker)
    where m.assetType = 'Stock' and m.exchange = 'NYSE'
      or (m.exchange = 'NASDAQ' and a.date >= date '{NASDAQ_FROM}')),
  measured as (
    select *, {_volatility(250)} as volatility_12m, {_volatility(400)} as volatility_36m,
      {_sma('adjVolume', 250)} as SMA_volume_12m,
      stddev_samp(adjVolume) over {_W.format(p='ticker', n=250)}
        / nullif({_sma('adjVolume', 250)}, 0) as volume_volatility_12m
    from chosen join market using (date)),
  sampled as (
    select * from measured where day(date) >= 17 and month(date) in (2, 5, 8, 11)
    qualify row_number() over (partition by ticker, year(date), quarter(date) order by date) = 1),
  lines as (
    select ticker, last_day(make_date(year(day), quarter(day) * 3, 1)) as fiscal_date,
      concat_ws('_', statementType, dataCode) as metric, amount
    from statement_lines where dataCode is not null),
  pivoted as (
    select ticker, fiscal_date, fiscal_date + 45 as safe_release_date, {_PIVOTED}
    from lines group by ticker, fiscal_date),
  company as (
    select * from meta qualify row_number() over (partition by upper(ticker)
      order by isActive desc, statementLastUpdated desc, permaTicker) = 1),
  described as (
    select p.*, c.name, c.isADR, c.sector, c.industry, c.sicSector, c.sicIndustry,
      c.reportingCurrency, c.location
    from pivoted p left join company c on p.ticker = upper(c.ticker)),
  wide as (
    select s.* exclude (close), x.* exclude (ticker, fiscal_date, safe_release_date)
    from sampled s asof join described x on s.ticker = x.ticker and s.date >= x.safe_release_date)"""

_WITH_DAILY = f"""{_WIDE},
  with_daily as (
    select w.*, r.* exclude (ticker, date) from wide w left join daily_ratios r
      on w.ticker = r.ticker and w.date = r.date)"""

_REV = "incomeStatement_revenue"
_COMBINED = f"""{_WITH_DAILY},
  combined as (
    select *,
      case when {_REV} > 0 then (incomeStatement_sga + incomeStatement_rnd) / {_REV} end
        as operating_efficiency,
      case when {_REV} > 0 then (cashFlow_capex + incomeStatement_rnd) / {_REV} end
        as growth_investment_intensity,
      {_REV} / nullif(balanceSheet_ppeq + balanceSheet_intangibles, 0) as asset_productivity,
      stddev_samp(overview_grossMargin) over {_W.format(p='ticker', n=4)} as margin_stability,
      (balanceSheet_inventory + balanceSheet_acctRec - balanceSheet_acctPay) / nullif({_REV}, 0) * 365
        as working_capital_days,
      nullif(enterpriseVal, 0) / nullif(incomeStatement_ebitda, 0) as ev_to_ebitda,
      nullif(enterpriseVal, 0) / nullif(cashFlow_freeCashFlow, 0) as ev_to_fcf,
      nullif(enterpriseVal, 0) / nullif({_REV}, 0) as ev_to_sales,
      overview_currentRatio / nullif(overview_debtEquity, 0) as financial_health_score
    from with_daily)"""

_METRICS = {
    "SMA_12m": 3, "SMA_36m": 3, "SPY_SMA_12m": 3, "SPY_SMA_36m": 3, "volatility_12m": 4,
    "volatility_36m": 4, "SMA_volume_12m": 3, "volume_volatility_12m": 4,
}
_RATIOS = {
    "operating_efficiency": 4, "growth_investment_intensity": 4, "asset_productivity": 4,
    "margin_stability": 1, "working_capital_days": 3, "ev_to_ebitda": 4, "ev_to_fcf": 4,
    "ev_to_sales": 4, "financial_health_score": 4,
}


def _rounding(digits: dict[str, int]) -> str:
    return ", ".join(f"round({c}, {n}) as {c}" for c, n in digits.items())


def _round_all(df, digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


def _inputs(spark, d):
    return {n: table(spark, d, n) for n in ("prices", "members", "statements", "meta")}


def _wide(spark, d):
    t = _inputs(spark, d)
    return features.wide_statements(
        t["prices"], t["members"], t["statements"], t["meta"], METRIC_NAMES, periods=PERIODS,
        nasdaq_from=NASDAQ_FROM, parts=features.price_parts(t["prices"]),
    )


@bind("sampled_prices", "K9 E1 E2 E4 E5 B9 B10 C2 C3 D1", f"""
    with {_WIDE} select * replace ({_rounding(_METRICS)}) from sampled""")
def _(spark, d):
    prices = table(spark, d, "prices")
    out = features.sampled_prices(
        prices, table(spark, d, "members"), periods=PERIODS, nasdaq_from=NASDAQ_FROM, parts=features.price_parts(prices),
    )
    return _round_all(out, _METRICS)


@bind("sampled_prices_bucketed", "A15 K9", f"""
    with {_WIDE} select * replace ({_rounding(_METRICS)}) from sampled""")
def _(spark, d):
    # Kept by ticker, the prices enter the chain without a shuffle; a bucket is a task, so large tables have more of them.
    rows = table(spark, d, "prices")
    buckets = max(16, features.price_parts(rows))
    prices = bucketed_table(
        rows.repartition(buckets, "ticker"), f"prices_{uuid.uuid4().hex}", "ticker", ["date"], buckets, scratch_path(spark, "bucketed"),
    )
    out = features.sampled_prices(prices, table(spark, d, "members"), periods=PERIODS, nasdaq_from=NASDAQ_FROM)
    return _round_all(out, _METRICS)


@bind("pivoted_statements", "K9 D2 B11 H2 H7", f"with {_WIDE} select * from pivoted")
def _(spark, d):
    return features.pivoted_statements(table(spark, d, "statements"), METRIC_NAMES)


@bind("wide_statements", "K9 C1 C5 B13", f"with {_WIDE} select * replace ({_rounding(_METRICS)}) from wide")
def _(spark, d):
    return _round_all(_wide(spark, d), _METRICS)


@bind("wide_with_daily_fundamentals", "K10 C4", f"""
    with {_WITH_DAILY} select * replace ({_rounding(_METRICS)}) from with_daily""")
def _(spark, d):
    out = features.wide_with_daily_fundamentals(_wide(spark, d), table(spark, d, "daily_ratios"))
    return _round_all(out, _METRICS)


@bind("wide_with_combined_metrics", "K11 H17 E6", f"""
    with {_COMBINED} select * replace ({_rounding(_METRICS | _RATIOS)}) from combined""")
def _(spark, d):
    daily = features.wide_with_daily_fundamentals(_wide(spark, d), table(spark, d, "daily_ratios"))
    return _round_all(features.wide_with_combined_metrics(daily), _METRICS | _RATIOS)


def _forward(price: str, n: int) -> str:
    return f"lead({price}, {n}) over (partition by ticker order by date) / nullif({price}, 0)"


def _excess(n: int) -> str:
    stock, index = _forward("adjClose", n), _forward("SPY_adjClose", n)
    return f"case when ({index}) > 0 and ({stock}) > 0 then ln(nullif(({stock}) / ({index}), 0)) end"


def _development(label: str, over: str) -> str:
    return f"""nullif((SMA_{label} / nullif(lag(SMA_{label}) over (partition by ticker order by date), 0))
      / nullif(SPY_SMA_{label} / nullif(lag(SPY_SMA_{label}) over ({over}), 0), 0), 0)"""


_EXCLUDED = [c for c in features.TRAINING_EXCLUDED if c in METRIC_NAMES or c in (
    "isADR", "marketCap", "reportingCurrency", "adjVolume", "trailingPEG1Y")]
_RETURNS = {f"excess_return_ln_{h}": 4 for h in features.HORIZONS} | {
    f"relative_sma_development_{p}": 4 for p in PERIODS
}
_KEPT = {k: n for k, n in (_METRICS | _RATIOS | _RETURNS).items() if "SMA_" not in k or "volume" in k}


def _excess_sql(over: str) -> str:
    horizons = ", ".join(f"{_excess(n)} as excess_return_ln_{h}" for h, n in features.HORIZONS.items())
    growth = ", ".join(f"{_development(p, over)} as relative_sma_development_{p}" for p in PERIODS)
    return f"""with {_COMBINED}, returns as (select *, {horizons}, {growth} from combined)
      select * exclude (SPY_adjClose, adjClose, SMA_12m, SMA_36m, SPY_SMA_12m, SPY_SMA_36m,
        {', '.join(_EXCLUDED)}) replace ({_rounding(_KEPT)}) from returns"""


def _training(spark, d, index_lag="key"):
    t = _inputs(spark, d)
    return features.training_table(
        t["prices"], t["members"], t["statements"], table(spark, d, "daily_ratios"), t["meta"],
        METRIC_NAMES, periods=PERIODS, index_lag=index_lag, nasdaq_from=NASDAQ_FROM,
        parts=features.price_parts(t["prices"]),
    )


@bind("excess_returns", "K12 E7 E8 H12 B13 F1", _excess_sql("partition by ticker order by date"))
def _(spark, d):
    return _round_all(_training(spark, d), _KEPT)


@bind("excess_returns_global_lag", "K12 E8", _excess_sql("order by date, ticker"))
def _(spark, d):
    return _round_all(_training(spark, d, "global"), _KEPT)


# ---- predictions and display ----------------------------------------------------------------

_RELEVANT = """relevant as (
    select p.*, c.name, c.sector, c.industry, c.sicSector, c.location, c.statementLastUpdated
    from predictions p join (
      select * from meta where isActive
      qualify row_number() over (partition by upper(ticker)
        order by statementLastUpdated desc, permaTicker) = 1) c on p.ticker = upper(c.ticker)
    where p.trained_date = (select max(trained_date) from predictions))"""
_SHOWN = "name, sector, industry, sicSector, location, statementLastUpdated"
_PER_HORIZON = f"""per_horizon as (
    select distinct ticker, right(pred_col, 3) as pred_horizon, predicted_value, predicted_std,
      {_SHOWN}, date as pred_date, trained_date, pred_col from relevant)"""


def _relevant(spark, d):
    return predictions.relevant_preds(table(spark, d, "predictions"), table(spark, d, "meta"))


def _horizons(spark, d):
    return predictions.relevant_horizons(table(spark, d, "predictions"), table(spark, d, "meta"))


@bind("relevant_preds", "K13 C7 C8", f"with {_RELEVANT} select * from relevant")
def _(spark, d):
    return _relevant(spark, d)


@bind("relative_performance", "K14 E9 D4 B8", """
    with daily as (
      select ticker, date, adjClose as first_adjClose from stock_prices
      where ticker in ('T1', 'T2', 'T5') and date between date '1998-01-01' and date '2000-12-31')
    select ticker, date, first_adjClose,
      first_adjClose / first_value(first_adjClose) over (partition by ticker order by date) as relative
    from daily""")
def _(spark, d):
    return predictions.relative_performance(
        table(spark, d, "stock_prices"), ["T1", "T2", "T5"], "1998-01-01", "2000-12-31",
    )


@bind("preds_per_horizon", "K15 H3 F4", f"with {_RELEVANT}, {_PER_HORIZON} select * from per_horizon")
def _(spark, d):
    return predictions.preds_per_horizon(_horizons(spark, d))


@bind("top_features", "K16 F2", f"""
    with {_RELEVANT} select feature, shap_value, feature_value from relevant
    where ticker = 'T4' and pred_col = 'excess_return_ln_12m'""")
def _(spark, d):
    return predictions.top_features(_relevant(spark, d), "T4", "excess_return_ln_12m")


@bind("forecasts", "K17 H4 H8 H15 H16", f"""
    with {_RELEVANT} select distinct ticker, trained_date,
      trained_date + cast(regexp_extract(pred_col, '(\\d+)m', 1) as int) * 30 as forecast_date,
      pred_col, predicted_value, predicted_std, name, sector, industry, sicSector, location,
      2 * predicted_std as predicted_std_2, predicted_value - 2 * predicted_std as band_low,
      predicted_value + 2 * predicted_std as band_high
    from relevant where ticker in ('T4', 'T5', 'T6', 'T7')""")
def _(spark, d):
    return predictions.forecasts(_horizons(spark, d), ["t4", "T5", "T6", "t7"])


@bind("stock_picker", "K18 B12 D7 D8", f"""
    with {_RELEVANT}, {_PER_HORIZON} select * from per_horizon
    where pred_horizon in ('12m', '36m') and sector in ('ASIA', 'AFRICA')
      and predicted_value between 0.9 and 1.1 and predicted_std between 0 and 0.5""")
def _(spark, d):
    return predictions.stock_picker(
        _horizons(spark, d),
        {"pred_horizon": ["12m", "36m"], "sector": ["ASIA", "AFRICA"], "industry": []},
        {"predicted_value": (0.9, 1.1), "predicted_std": (0, 0.5)},
    )


@bind("stock_picker_rows", "K18 B20", f"""
    with {_RELEVANT}, {_PER_HORIZON}, numbered as (
      select *, row_number() over (order by ticker, pred_horizon, pred_date) - 1 as i
      from per_horizon where sector = 'ASIA')
    select * exclude (i) from numbered where i in (1, 5, 20)""")
def _(spark, d):
    return predictions.stock_picker(_horizons(spark, d), {"sector": ["ASIA"]}, positions=[1, 5, 20])


@bind("price_summary", "K19 D6 B8", """
    select ticker, max(date) as date, max_by(adjClose, date) as adjClose,
      array_to_string(list(trunc(adjClose)::bigint order by date), ',') as history,
      'https://finance.yahoo.com/quote/' || ticker as url
    from stock_prices where ticker in ('T1', 'T2', 'T5')
      and date between date '1998-01-01' and date '2000-12-31' group by ticker""")
def _(spark, d):
    out = predictions.price_summary(
        table(spark, d, "stock_prices"), ["T1", "T2", "T5"], "1998-01-01", "2000-12-31",
    )
    return out.withColumn("history", F.array_join(F.col("history").cast("array<string>"), ","))


@bind("first_last_extract", "K20 B21 F5 G1 A16", """
    with series as (select * from stock_prices where ticker = 'T7'),
    one as (select * from series order by date limit 1)
    select * from one union all
    select * from series where date = (select min(date) from series where date >= date '1999-01-01')""")
def _(spark, d):
    prices = table(spark, d, "stock_prices")
    day = prices.where("ticker = 'T7' and date >= date '1999-01-01'").agg(F.min("date")).first()[0]
    return predictions.first_last_extract(prices, "T7", str(day)).drop("_etl_loaded_at")


# ---- streams --------------------------------------------------------------------------------


@bind("stream_landing_upsert", "J1", """
    with late as (select * from stock_prices where date >= date '2001-01-01')
    select date, close, adjClose * 2 as adjClose, adjVolume, ticker from late
    union all
    select date, close, adjClose, adjVolume, ticker from stock_prices where date < date '2001-01-01'""")
def _(spark, d):
    """Files of the last year's prices arrive and replace what the table held."""
    prices = table(spark, d, "stock_prices").select("date", "close", "adjClose", "adjVolume", "ticker")
    target, feed = scratch_path(spark, "streamed"), scratch_path(spark, "feed")
    landing.create_table(prices, target)
    late = prices.where("date >= date '2001-01-01'").withColumn("adjClose", F.col("adjClose") * 2)
    late.write.option("header", True).csv(feed)
    query = landing.stream_landing_upsert(
        spark, feed, target, scratch_path(spark, "offsets"),
        "date date, close double, adjClose double, adjVolume double, ticker string",
        schemas.DAILY_ADJUSTED_KEY, [F.col("adjClose").desc()],
        ["date", "close", "adjClose", "adjVolume", "ticker"],
    )
    query.awaitTermination()
    return landing.read_table(spark, target)



@bind("stream_quarantine", "J1", """
    select date, close, case when date >= date '2001-01-01' and day(date) > 3 then adjClose * 2 else adjClose end as adjClose,
      adjVolume, ticker from stock_prices""")
def _(spark, d):
    """Good and broken files arrive, one of the good ones twice; the broken ones change nothing."""
    prices = table(spark, d, "stock_prices").select("date", "close", "adjClose", "adjVolume", "ticker")
    target, feed, marks = (scratch_path(spark, n) for n in ("quarantined", "feed", "offsets"))
    landing.create_table(prices, target)
    late = prices.where("date >= date '2001-01-01'").withColumn("adjClose", F.col("adjClose") * 2)
    good = late.where("day(date) > 3").coalesce(2)
    good.write.option("header", True).csv(feed)

    def run():
        landing.stream_landing_upsert(
            spark, feed, target, marks, "date date, close double, adjClose double, adjVolume double, ticker string",
            schemas.DAILY_ADJUSTED_KEY, [F.col("adjClose").desc()], ["date", "close", "adjClose", "adjVolume", "ticker"],
        ).awaitTermination()

    run()
    broken = late.where("day(date) <= 3").withColumn("close", F.when(F.dayofmonth("date") == 1, "n/a").otherwise(F.col("close").cast("string")))
    broken.coalesce(1).write.mode("append").option("header", True).csv(feed)
    good.write.mode("append").option("header", True).csv(feed)
    run()
    return landing.read_table(spark, target)


@bind("stream_restatement", "J2 K6", """
    with latest as (
      select date, close, adjClose, adjVolume, upper(ticker) as ticker from snapshot
      qualify row_number() over (partition by upper(ticker) order by divCash desc, adjClose desc) = 1),
    acted as (select distinct upper(ticker) as ticker from snapshot where splitFactor <> 1.0 or divCash > 0),
    history as (
      select date, close, adjClose / 2 as adjClose, adjVolume, ticker from stock_prices
      where ticker in (select ticker from acted)),
    base as (
      select date, close, adjClose, adjVolume, ticker from stock_prices
      where (ticker, date) not in (select (ticker, date) from latest)
      union all select * from latest)
    select * from history
    union all select * from base where (ticker, date) not in (select (ticker, date) from history)""")
def _(spark, d):
    """A snapshot arrives; tickers with a split or dividend get their halved history."""
    prices = table(spark, d, "stock_prices").select("date", "close", "adjClose", "adjVolume", "ticker")
    target, feed = scratch_path(spark, "restated"), scratch_path(spark, "snapshot")
    landing.create_table(prices, target)
    snapshot = table(spark, d, "snapshot").drop("line")
    snapshot.write.option("header", True).csv(feed)
    halved = prices.withColumn("adjClose", F.col("adjClose") / 2)

    def history(session, keys):
        return halved.join(keys, "ticker", "left_semi")

    query = landing.stream_landing_upsert(
        spark, feed, target, scratch_path(spark, "offsets"),
        "ticker string, date date, close double, adjClose double, adjVolume double, divCash double, "
        "splitFactor double",
        schemas.DAILY_ADJUSTED_KEY, [F.col("divCash").desc(), F.col("adjClose").desc()],
        ["date", "close", "adjClose", "adjVolume", "ticker"], history,
        [F.col("adjClose").desc()],
    )
    query.awaitTermination()
    return landing.read_table(spark, target)


@bind("upsert_null_partition", "A9 J1", """
    select o_orderkey, case when o_orderpriority = '1-URGENT' then null else o_orderpriority end as priority,
      case when o_orderpriority = '1-URGENT' and o_orderkey % 2 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice
    from orders""")
def _(spark, d):
    """Updates of a null partition: its other rows stay."""
    path = scratch_path(spark, "null_parts")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    o = table(spark, d, "orders").select("o_orderkey", F.when(~urgent, F.col("o_orderpriority")).alias("priority"), "o_totalprice")
    o.write.partitionBy("priority").parquet(path)
    late = o.where("priority is null and o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert_partitions(spark, path, late, ["o_orderkey"], "priority")
    return spark.read.parquet(path).select("o_orderkey", "priority", "o_totalprice")


@bind("versioned_upsert", "A9 A11", """
    select o_orderkey, o_orderpriority, case when o_orderkey % 3 = 0 and o_orderpriority in ('1-URGENT', '5-LOW') then o_totalprice + 1
      else o_totalprice end as o_totalprice from orders""")
def _(spark, d):
    """Two priorities get updates, in one step for readers; the others keep their files."""
    root = scratch_path(spark, "versions")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    versions.create_versioned(o, root, "o_orderpriority")
    late = o.where("o_orderkey % 3 = 0 and o_orderpriority in ('1-URGENT', '5-LOW')").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    versions.upsert_versioned(spark, root, late, ["o_orderkey"], "o_orderpriority")
    return versions.read_versioned(spark, root)


@bind("daily_upsert", "A9 K5", f"""
    with {_UNIVERSE}, {_SELECTED}
    select date, close, adjClose, adjVolume, ticker from stock_prices
    where (ticker, date) not in (select (ticker, date) from selected)
    union all select date, close, adjClose, adjVolume, ticker from selected""")
def _(spark, d):
    """The selected prices of the day into the sliced price table."""
    prices = table(spark, d, "stock_prices").select("date", "close", "adjClose", "adjVolume", "ticker")
    path = scratch_path(spark, "sliced")
    landing.create_table(prices, path)
    day = landing.with_partition(_refreshed(spark, d).snapshot.select(*prices.columns))
    upsert_partitions(spark, path, day, schemas.DAILY_ADJUSTED_KEY, landing.PARTITION)
    return landing.read_table(spark, path).select(*prices.columns)


@bind("refresh_then_read", "A8 K5", f"with {_UNIVERSE} select ticker, exchange from universe")
def _(spark, d):
    path = scratch_path(spark, "universe")
    full_refresh(_universe(spark, d).select("ticker", "exchange"), path)
    return spark.read.parquet(path)
