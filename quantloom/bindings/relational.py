"""Bound queries: filters, joins, aggregation, ordering, sets and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.bindings.registry import bind, rounded, table
from quantloom.functions import macros, scalars
from quantloom.operators import filters, joins, ordering, reshape, selection, setops

# ---- filters -------------------------------------------------------------------------------


@bind("filter_universe", "B1 C9 D3", """
    select * from supported
    where exchange in ('NYSE', 'NASDAQ', 'NYSE MKT', 'NYSE ARCA', 'AMEX') and startDate is not null
      and (assetType = 'Stock'
        or (assetType = 'ETF' and endDate = (select max(endDate) from supported)))""")
def _(spark, d):
    return filters.filter_universe(table(spark, d, "supported"))


@bind("exclude_keys", "B2 G3", """
    select c_custkey, c_mktsegment from customer
    where upper(c_mktsegment) not in ('BUILDING', 'MACHINERY')""")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return filters.exclude_keys(c, "c_mktsegment", ["building", "Machinery", "unknown"])


@bind("exclude_keys_table", "B2 C10", """
    select ticker, permaTicker from meta
    where upper(ticker) not in (select ticker from stock_prices where adjVolume > 160)""")
def _(spark, d):
    busy = table(spark, d, "stock_prices").where("adjVolume > 160").select("ticker")
    return filters.exclude_keys(table(spark, d, "meta"), "ticker", busy).select("ticker", "permaTicker")


@bind("include_keys", "B3 H1", """
    select upper(ticker) as ticker, exchange from supported where upper(ticker) in ('T1', 'T7', 'T99')""")
def _(spark, d):
    s = table(spark, d, "supported").select("ticker", "exchange")
    return filters.include_keys(s, "ticker", ["t1", "T7", "t99", "nothing"])


@bind("skip_existing", "B4 C10", """
    select c_custkey as key from customer where c_custkey not in (select s_suppkey from supplier)""")
def _(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return filters.skip_existing(keys, "key", table(spark, d, "supplier"), "s_suppkey")


@bind("lookback", "B5 H9", """
    select o_orderkey, cast(o_orderdate as date) as day from orders
    where cast(o_orderdate as date) >= date '2001-06-30' - interval 200 days""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return filters.lookback(o, "day", 200, F.lit("2001-06-30").cast("date"))


@bind("relative_date", "B6", """
    select event_id, cast(ts - interval 50 hours - interval 30 minutes as date) as day from events""")
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id", scalars.relative_date("today-50h30m", F.col("ts")).alias("day"),
    )


@bind("corporate_actions", "B7", """
    select ticker, line, splitFactor, divCash from snapshot where splitFactor <> 1.0 or divCash > 0""")
def _(spark, d):
    rows = filters.corporate_actions(table(spark, d, "snapshot"))
    return rows.select("ticker", "line", "splitFactor", "divCash")


@bind("date_selection", "B8", """
    select * from stock_prices where ticker in ('T1', 'T2', 'T3')
      and date between date '1997-01-01' and date '1998-12-31'""")
def _(spark, d):
    return filters.date_selection(
        table(spark, d, "stock_prices"), "ticker", "date", ["T1", "T2", "T3"],
        "1997-01-01", "1998-12-31",
    )


_MEMBER_PRICES = "select p.*, m.exchange, m.assetType from stock_prices p join members m using (ticker)"


@bind("training_universe", "B9 C2", f"""
    select * from ({_MEMBER_PRICES}) where assetType = 'Stock' and exchange = 'NYSE'
      or (exchange = 'NASDAQ' and date >= date '1998-10-01')""")
def _(spark, d):
    rows = joins.inner_join(table(spark, d, "stock_prices"), table(spark, d, "members"), ["ticker"])
    return filters.training_universe(rows, nasdaq_from="1998-10-01")


@bind("training_universe_strict", "B9", f"""
    select * from ({_MEMBER_PRICES}) where assetType = 'Stock' and (exchange = 'NYSE'
      or (exchange = 'NASDAQ' and date >= date '1998-10-01'))""")
def _(spark, d):
    rows = joins.inner_join(table(spark, d, "stock_prices"), table(spark, d, "members"), ["ticker"])
    return filters.training_universe(rows, nasdaq_from="1998-10-01", strict=True)


@bind("calendar_filter", "B10 H6", """
    select ticker, date from stock_prices where day(date) >= 17 and month(date) in (2, 5, 8, 11)""")
def _(spark, d):
    return filters.calendar_filter(table(spark, d, "stock_prices")).select("ticker", "date")


@bind("drop_annual", "B11", "select * from statements where quarter != 0")
def _(spark, d):
    return filters.drop_annual(table(spark, d, "statements"))


@bind("facet_filter", "B12 H18", """
    select c_custkey, c_mktsegment, c_acctbal from customer
    where c_mktsegment in ('BUILDING', 'FURNITURE') and c_acctbal between 0 and 5000""")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return filters.facet_filter(
        c, {"c_mktsegment": ["BUILDING", "FURNITURE"], "c_custkey": []}, {"c_acctbal": (0, 5000)},
    )


@bind("select_except", "B13", "select * exclude (o_orderpriority, o_totalprice) from orders")
def _(spark, d):
    return filters.select_except(table(spark, d, "orders"), ["o_orderpriority", "o_totalprice"])


@bind("drop_null_target", "B14", """
    select ticker, exchange, startDate from supported where startDate is not null""")
def _(spark, d):
    s = table(spark, d, "supported").select("ticker", "exchange", "startDate")
    return filters.drop_null_target(s, "startDate")


@bind("normalise_types", "B15", """
    select o_orderkey, cast(cast(o_totalprice as decimal(18,3)) as double) as price,
      coalesce(nullif(o_orderstatus, 'P'), 'None') as status from orders""")
def _(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,3)").alias("price"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
    )
    return filters.normalise_types(o)


_HALF = """select c_name as key from (
    select c_name, row_number() over (order by c_name) - 1 as i, count(*) over () as n from customer)
    where i {} n // 2"""


@bind("half_split_first", "B16 E11", _HALF.format("<"))
def _(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_name").alias("key"))
    return ordering.half_for_hour(keys, "key", 14)


@bind("half_split_second", "B16", _HALF.format(">="))
def _(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_name").alias("key"))
    return ordering.half_for_hour(keys, "key", 15)


@bind("assign_batches", "B17", """
    select c_name as key, (row_number() over (order by c_name) - 1) // 250 as batch from customer""")
def _(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_name").alias("key"))
    return ordering.assign_batches(keys, "key", 250)


@bind("sample_n", "B18", """
    select o_orderkey, o_orderstatus from orders
    order by md5(concat_ws('|', cast(o_orderkey as varchar), '7')), o_orderkey limit 20""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return ordering.sample_n(o, 20, ["o_orderkey"], seed=7)


@bind("since_inclusive", "B19", "select ticker, date from stock_prices where date >= date '2001-06-01'")
def _(spark, d):
    return filters.since(table(spark, d, "stock_prices"), "date", "2001-06-01").select("ticker", "date")


@bind("since_exclusive", "B19", "select ticker, date from stock_prices where date > date '2001-06-01'")
def _(spark, d):
    rows = filters.since(table(spark, d, "stock_prices"), "date", "2001-06-01", inclusive=False)
    return rows.select("ticker", "date")


@bind("pick_rows", "B20", """
    select o_orderkey, o_totalprice from (
      select *, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as i from orders)
    where i in (0, 3, 10, 100)""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return selection.pick_rows(o, [selection.Key("o_totalprice", descending=True), "o_orderkey"], [0, 3, 10, 100])


@bind("lookup_day", "B21", """
    select * from stock_prices where date = date '1999-03-15'""")
def _(spark, d):
    return filters.lookup_day(table(spark, d, "stock_prices"), "date", "1999-03-15")


# ---- joins ---------------------------------------------------------------------------------

_CLICKS = "select event_id, user_id, ts, value from events where event_type = 'click'"
_BUYS = """select user_id, ts as bought_at, event_id as buy_id, value as buy_value
    from events where event_type = 'purchase'"""


def _asof_sides(spark, d):
    events = table(spark, d, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    buys = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("buy_id"),
        F.col("value").alias("buy_value"),
    )
    return clicks, buys


@bind("asof_join", "C1", f"""
    select c.event_id, c.user_id, c.ts, c.value, b.bought_at, b.buy_id, b.buy_value
    from ({_CLICKS}) c asof join ({_BUYS}) b on c.user_id = b.user_id and c.ts >= b.bought_at""")
def _(spark, d):
    clicks, buys = _asof_sides(spark, d)
    return joins.asof_join(clicks, buys, ["user_id"], "ts", "bought_at", tie_break=["buy_id"])


@bind("asof_left_join", "C1", f"""
    select c.event_id, c.user_id, c.ts, c.value, b.bought_at, b.buy_id, b.buy_value
    from ({_CLICKS}) c asof left join ({_BUYS}) b on c.user_id = b.user_id and c.ts >= b.bought_at""")
def _(spark, d):
    clicks, buys = _asof_sides(spark, d)
    return joins.asof_join(
        clicks, buys, ["user_id"], "ts", "bought_at", how="left", tie_break=["buy_id"],
    )


@bind("asof_join_hot_keys", "C1", f"""
    select c.event_id, c.user_id, c.ts, c.value, b.bought_at, b.buy_id, b.buy_value
    from ({_CLICKS}) c asof join ({_BUYS}) b on c.user_id = b.user_id and c.ts >= b.bought_at""")
def _(spark, d):
    """The same join when almost every key counts as hot and is cut into time slices."""
    clicks, buys = _asof_sides(spark, d)
    return joins.asof_join(
        clicks, buys, ["user_id"], "ts", "bought_at", tie_break=["buy_id"], max_group_rows=8,
    )


@bind("join_calendar", "C3", """
    select s.ticker, s.date, s.adjClose, m.adjClose as market
    from stock_prices s join market_prices m using (date)""")
def _(spark, d):
    days = table(spark, d, "market_prices").select("date", F.col("adjClose").alias("market"))
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    return joins.join_calendar(rows, days, "date")


@bind("left_join", "C4", """
    select s.ticker, s.date, s.adjClose, r.enterpriseVal from stock_prices s
    left join (select * from daily_ratios where peRatio > 30) r using (ticker, date)""")
def _(spark, d):
    ratios = table(spark, d, "daily_ratios").where("peRatio > 30").select("ticker", "date", "enterpriseVal")
    rows = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    return joins.left_join(rows, ratios, ["ticker", "date"])


@bind("left_join_upper", "C5 H1", """
    select m.ticker, m.exchange, x.permaTicker from members m
    left join (select * from meta where isActive) x on m.ticker = upper(x.ticker)""")
def _(spark, d):
    active = table(spark, d, "meta").where("isActive").select("ticker", "permaTicker")
    return joins.left_join_upper(
        table(spark, d, "members").select("ticker", "exchange"), active, "ticker", "ticker",
    )


@bind("semi_join_upper", "C6", """
    select ticker, exchange from supported
    where lower(ticker) in (select lower(ticker) from stock_prices)""")
def _(spark, d):
    s = table(spark, d, "supported").select("ticker", "exchange")
    return joins.semi_join_upper(s, table(spark, d, "stock_prices"), "ticker", "ticker")


@bind("latest_only", "C7 D3", """
    select ticker, date, feature, shap_value from predictions
    where trained_date = (select max(trained_date) from predictions)""")
def _(spark, d):
    rows = filters.latest_only(table(spark, d, "predictions"), "trained_date")
    return rows.select("ticker", "date", "feature", "shap_value")


@bind("left_join_filtered_right", "C8", """
    select p.ticker, p.date, m.permaTicker from stock_prices p
    left join meta m on p.ticker = upper(m.ticker) where m.isActive""")
def _(spark, d):
    meta = table(spark, d, "meta").select("ticker", "permaTicker", "isActive")
    rows = table(spark, d, "stock_prices").select("ticker", "date")
    return joins.left_join_upper(rows, meta, "ticker", "ticker").where("isActive").drop("isActive")


@bind("with_scalar", "C9 D3", """
    select ticker, endDate, (select max(endDate) from supported) as last_day from supported""")
def _(spark, d):
    s = table(spark, d, "supported").select("ticker", "endDate")
    return joins.with_scalar(s, F.max("endDate"), "last_day")


@bind("anti_join", "C10", """
    select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)""")
def _(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_join(table(spark, d, "orders").select("o_orderkey"), li, ["o_orderkey"])


# ---- aggregation and reshaping --------------------------------------------------------------


@bind("pivot_multi", "D1", """
    select date,
      max(adjClose) filter (ticker = 'A') as "A_adjClose", max(adjVolume) filter (ticker = 'A') as "A_adjVolume",
      max(adjClose) filter (ticker = 'N') as "N_adjClose", max(adjVolume) filter (ticker = 'N') as "N_adjVolume",
      max(adjClose) filter (ticker = 'R') as "R_adjClose", max(adjVolume) filter (ticker = 'R') as "R_adjVolume"
    from index_prices group by date""")
def _(spark, d):
    return reshape.pivot_multi(
        table(spark, d, "index_prices"), "ticker", ["A", "N", "R"], ["date"],
        ["adjClose", "adjVolume"], order="date",
    )


@bind("pivot_sum", "D2", """
    with q as (select l_suppkey, year(l_shipdate)::int as year, l_returnflag || '_' || l_linestatus as metric,
        cast(l_extendedprice as decimal(18,2)) as v from lineitem)
    select l_suppkey, year, cast(sum(v) filter (metric = 'A_F') as double) as "A_F",
      cast(sum(v) filter (metric = 'A_O') as double) as "A_O",
      cast(sum(v) filter (metric = 'N_F') as double) as "N_F",
      cast(sum(v) filter (metric = 'N_O') as double) as "N_O",
      cast(sum(v) filter (metric = 'R_F') as double) as "R_F",
      cast(sum(v) filter (metric = 'R_O') as double) as "R_O"
    from q group by l_suppkey, year""")
def _(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("year"),
        scalars.metric_name("l_returnflag", "l_linestatus").alias("metric"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("v"),
    )
    wide = reshape.pivot_sum(li, "metric", "v", ["l_suppkey", "year"])
    return wide.select(
        "l_suppkey", "year", *[F.col(c).cast("double").alias(c) for c in wide.columns[2:]],
    )


@bind("pivot_map", "D2", """
    with q as (select l_returnflag, year(l_shipdate)::int as year, 'part_' || l_partkey as metric,
        cast(sum(cast(l_extendedprice as decimal(18,2))) * 100 as bigint) as v from lineitem group by 1, 2, 3)
    select l_returnflag, year, count(*)::int as n_metrics, string_agg(metric || '=' || v, ',' order by metric) as metrics,
      max(v) filter (metric = 'part_1') as "part_1", max(v) filter (metric = 'part_17') as "part_17"
    from q group by l_returnflag, year""")
def _(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_returnflag", F.year("l_shipdate").alias("year"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("metric"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint").alias("v"),
    )
    wide = reshape.pivot_map(li, "metric", "v", ["l_returnflag", "year"])
    entries = F.transform(F.map_entries("metrics"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    text = wide.withColumns({"n_metrics": F.size("metrics"), "text": F.array_join(entries, ",")})
    return reshape.map_columns(text, ["part_1", "part_17"]).withColumnRenamed("text", "metrics")


@bind("global_max", "D3", "select max(o_orderdate)::date as last_day from orders")
def _(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return reshape.global_max(o, "day", "last_day")


@bind("first_per_group", "D4", """
    select l_suppkey, l_shipdate::date as day, min(l_extendedprice) as price
    from lineitem group by l_suppkey, l_shipdate::date""")
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return reshape.first_per_group(li, ["l_suppkey", "day"], "l_extendedprice", "l_extendedprice", "price")


@bind("distinct_keys", "D5", "select distinct ticker, pred_col from predictions")
def _(spark, d):
    return reshape.distinct_keys(table(spark, d, "predictions"), "ticker", "pred_col")


@bind("series_summary", "D6 H5", """
    select ticker, max(date) as date, max_by(adjClose, date) as adjClose,
      array_to_string(list(trunc(adjClose)::bigint order by date), ',') as history,
      'https://finance.yahoo.com/quote/' || ticker as url
    from stock_prices group by ticker""")
def _(spark, d):
    out = reshape.series_summary(table(spark, d, "stock_prices"), "ticker", "date", "adjClose")
    return out.withColumn(
        "history", F.array_join(F.col("history").cast("array<string>"), ","),
    )


@bind("bounds", "D7", """
    select min(predicted_value) as min_predicted_value, max(predicted_value) as max_predicted_value,
      min(predicted_std) as min_predicted_std, max(predicted_std) as max_predicted_std
    from predictions""")
def _(spark, d):
    return reshape.bounds(table(spark, d, "predictions"), ["predicted_value", "predicted_std"])


@bind("facet_values", "D8", """
    select distinct industry from meta where sector in ('ASIA', 'EUROPE') order by industry""")
def _(spark, d):
    return reshape.facet_values(table(spark, d, "meta"), "industry", "sector", ["ASIA", "EUROPE"])


@bind("count_rows", "D9", "select count(*) as n_rows from lineitem")
def _(spark, d):
    return reshape.count_rows(table(spark, d, "lineitem"))


@bind("profile_table", "D10", """
    select n_rows, position, "column", type, n_null from (
      select count(*) as n_rows, 0 as position, 'ticker' as "column", 'string' as type,
        count(*) filter (ticker is null) as n_null from supported
      union all select count(*), 1, 'exchange', 'string', count(*) filter (exchange is null) from supported
      union all select count(*), 2, 'startDate', 'date', count(*) filter (startDate is null) from supported)""")
def _(spark, d):
    return reshape.profile_table(table(spark, d, "supported").select("ticker", "exchange", "startDate"))


@bind("preview", "D10", "select * from orders order by o_orderkey limit 5")
def _(spark, d):
    return reshape.preview(table(spark, d, "orders"), ["o_orderkey"])


def _described(column: str) -> str:
    return f"""select '{column}' as "column", count({column}) as count,
      count(*) filter ({column} is null) as null_count, round(avg({column}), 2) as mean,
      round(stddev_samp({column}), 2) as std, min({column}) as min,
      quantile_disc({column}, 0.25) as q25, quantile_disc({column}, 0.5) as q50,
      quantile_disc({column}, 0.75) as q75, max({column}) as max from lineitem"""


@bind("describe", "D11", " union all ".join(
    _described(c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def _(spark, d):
    out = reshape.describe(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(out, 2, "mean", "std")


def _described_values(column: str) -> str:
    return f"""select '{column}' as column, count({column}) as count, count(*) filter ({column} is null) as null_count,
      cast(min({column}) as varchar) as min, cast(max({column}) as varchar) as max from orders"""


@bind("describe_values", "D11", " union all ".join(map(_described_values, ("o_orderstatus", "o_orderpriority", "o_orderkey"))))
def _(spark, d):
    return reshape.describe_values(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_orderkey"])


@bind("describe_sketched", "D11", _described("l_quantity"))
def _(spark, d):
    out = reshape.describe(table(spark, d, "lineitem"), ["l_quantity"], accuracy=100_000)
    return rounded(out, 2, "mean", "std")


@bind("running_total", "E11", """
    select p_partkey, sum(p_size) over (order by p_retailprice, p_partkey)::bigint as upto from part""")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    out = ordering.with_running_total(p, ["p_retailprice", "p_partkey"], "p_size")
    return out.select("p_partkey", "upto")


@bind("rmse", "D12", """
    select round(sqrt(avg((p_retailprice - (900 + p_partkey / 10.0)) ** 2)), 3) as rmse from part""")
def _(spark, d):
    p = table(spark, d, "part").withColumn("guess", 900 + F.col("p_partkey") / 10.0)
    return rounded(reshape.rmse(p, "p_retailprice", "guess"), 3, "rmse")


# ---- order, sets ----------------------------------------------------------------------------


@bind("in_key_order", "F1", "select ticker, date, adjVolume from stock_prices order by ticker, date desc")
def _(spark, d):
    return ordering.in_key_order(
        table(spark, d, "stock_prices").select("ticker", "date", "adjVolume"), "ticker", "date",
    )


@bind("top_by_magnitude", "F2", """
    select ticker, pred_col, date, feature, shap_value, rank from (
      select *, row_number() over (partition by ticker, pred_col
        order by abs(shap_value) desc, date, feature, trained_date) as rank from predictions)
    where rank <= 3""")
def _(spark, d):
    rows = ordering.top_by_magnitude(
        table(spark, d, "predictions"), ["ticker", "pred_col"], "shap_value", 3,
        [F.col("date").asc(), F.col("feature").asc(), F.col("trained_date").asc()],
    )
    return rows.select(
        "ticker", "pred_col", "date", "feature", "shap_value", F.col("rank").cast("bigint").alias("rank"),
    )


@bind("by_magnitude", "F3", """
    select date, ticker, feature, shap_value from predictions order by date, ticker, abs(shap_value) desc""")
def _(spark, d):
    return ordering.by_magnitude(
        table(spark, d, "predictions").select("date", "ticker", "feature", "shap_value"),
        "shap_value", ["date", "ticker"],
    )


@bind("head_rows", "F5", "select * from customer order by c_acctbal, c_custkey limit 10")
def _(spark, d):
    return ordering.head_rows(
        table(spark, d, "customer"), [F.col("c_acctbal").asc_nulls_last(), F.col("c_custkey").asc()], 10,
    )


@bind("tail_rows", "F5", "select * from customer order by c_acctbal desc, c_custkey desc limit 10")
def _(spark, d):
    return ordering.tail_rows(
        table(spark, d, "customer"), [F.col("c_acctbal").desc(), F.col("c_custkey").desc()], 10,
    )


@bind("shared_keys", "G2", "select c_custkey as key from customer intersect select s_suppkey from supplier")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return setops.shared_keys(c, table(spark, d, "supplier").select(F.col("s_suppkey").alias("key")), "key")


@bind("missing_keys", "G3", "select c_custkey as key from customer except select s_suppkey from supplier")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return setops.missing_keys(c, table(spark, d, "supplier").select(F.col("s_suppkey").alias("key")), "key")


# ---- scalars --------------------------------------------------------------------------------


@bind("text_functions", "H1 H2 H3 H4 H5", """
    select date, ticker, feature, lower(ticker) as low, concat_ws('_', feature, nullif(ticker, 'T1')) as metric,
      right(pred_col, 3) as horizon, cast(regexp_extract(pred_col, '(\\d+)m', 1) as bigint) as months,
      'https://finance.yahoo.com/quote/' || ticker as url
    from predictions""")
def _(spark, d):
    return table(spark, d, "predictions").select(
        "date", "ticker", "feature", F.lower("ticker").alias("low"),
        scalars.metric_name("feature", F.nullif("ticker", F.lit("T1"))).alias("metric"),
        scalars.horizon_label("pred_col").alias("horizon"),
        scalars.horizon_months("pred_col").alias("months"), scalars.quote_link("ticker").alias("url"),
    )


@bind("date_functions", "H6 H7 H8 H9", """
    select o_orderkey, day(o_orderdate)::int as d, month(o_orderdate)::int as m,
      quarter(o_orderdate)::int as q, year(o_orderdate)::int as y, o_orderdate::date + 45 as release,
      o_orderdate::date + 12 * 30 as forecast, (o_orderdate - interval 14 days)::date as before
    from orders""")
def _(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey", F.dayofmonth(day).alias("d"), F.month(day).alias("m"), F.quarter(day).alias("q"),
        F.year(day).alias("y"), scalars.release_date(day).alias("release"),
        scalars.forecast_date(day, F.lit(12)).alias("forecast"), F.date_sub(day, 14).alias("before"),
    )


@bind("conditionals_and_casts", "H10 H13 H19", """
    select o_orderkey, o_totalprice / nullif(o_custkey, 0) as ratio,
      try_cast(case when o_orderstatus = 'F' then 'True' when o_orderstatus = 'O' then 'False'
        else '' end as boolean) as flag,
      cast(try_cast(case when o_orderstatus = 'F' then '2024-11-02 01:01:16' else 'soon' end as timestamp)
        as date) as day,
      cast(try_cast(case when o_orderstatus = 'O' then '12.3456' else 'None' end as decimal(18,3))
        as double) as amount,
      cast(o_custkey as varchar) as text
    from orders""")
def _(spark, d):
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        "o_orderkey", scalars.safe_divide("o_totalprice", "o_custkey").alias("ratio"),
        scalars.text_to_bool(F.when(status == "F", "True").when(status == "O", "False").otherwise("")).alias("flag"),
        scalars.text_to_date(F.when(status == "F", "2024-11-02 01:01:16").otherwise("soon")).alias("day"),
        scalars.text_to_decimal(F.when(status == "O", "12.3456").otherwise("None")).cast("double").alias("amount"),
        F.col("o_custkey").cast("string").alias("text"),
    )


@bind("excess_return", "H11 H12", """
    select o_orderkey, round(case when o_custkey > 0 and o_totalprice - 1000 > 0
      then ln((o_totalprice - 1000) / o_custkey) end, 6) as excess from orders""")
def _(spark, d):
    macros.register_sql_functions(spark)
    return spark.sql(
        "select o_orderkey, round(excess_return(o_totalprice - 1000, o_custkey), 6) as excess "
        "from {orders}", orders=table(spark, d, "orders"),
    )


@bind("back_transform", "H11 H14 H15", """
    select date, ticker, feature, round(exp(predicted_value_log), 5) as value,
      round(sqrt(exp(2 * predicted_value_log) * abs(shap_value)), 4) as std,
      round(sqrt(exp(predicted_value_log) * 2 * abs(shap_value)), 4) as stored_std,
      round(predicted_value + 2 * predicted_std, 4) as high
    from predictions""")
def _(spark, d):
    variance = F.abs("shap_value")
    _, _, high = scalars.sigma_band("predicted_value", "predicted_std")
    out = table(spark, d, "predictions").select(
        "date", "ticker", "feature", scalars.back_transform("predicted_value_log").alias("value"),
        scalars.predicted_std("predicted_value_log", variance).alias("std"),
        scalars.predicted_std("predicted_value_log", variance, "stored").alias("stored_std"),
        high.alias("high"),
    )
    return rounded(rounded(out, 5, "value"), 4, "std", "stored_std", "high")


_UNIT = "('0x' || substr(md5(concat_ws('|', cast(o_orderkey as varchar), '{}')), 1, 7))::bigint"


@bind("jittered_date", "H16", f"""
    select o_orderkey, o_orderdate::date + to_seconds(
      floor({_UNIT.format(3)} / 268435456.0 * 40 * 86400)::bigint - 20 * 86400) as jittered
    from orders""")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        scalars.jittered(F.col("o_orderdate").cast("date"), "o_orderkey", seed=3).alias("jittered"),
    )


@bind("hash_split", "I1", f"""
    select o_orderkey, {_UNIT.format(5)} % 1000 as bucket from orders""")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", scalars.hash_bucket("o_orderkey", seed=5).alias("bucket"),
    )
