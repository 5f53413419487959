from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quantloom.functions import macros, scalars
from quantloom.operators import filters, joins, ordering, reshape, selection, setops

D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame([(c,) for c in "gcafbed"], "key string").repartition(5)


@pytest.mark.parametrize("keys,first,second", [
    ("", "", ""), ("A", "", "A"), ("ABCD", "AB", "CD"), ("ABC", "A", "BC"),
])
def test_halves(spark, keys, first, second):
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert "".join(r[0] for r in rows(ordering.half_split(df, "key", True))) == first
    assert "".join(r[0] for r in rows(ordering.half_split(df, "key", False))) == second


def test_positions_batches_and_picks(letters):
    assert rows(ordering.with_row_index(letters, ["key"])) == [(c, i) for i, c in enumerate("abcdefg")]
    assert rows(ordering.assign_batches(letters, "key", 3)) == [(c, i // 3) for i, c in enumerate("abcdefg")]
    assert {r[1] for r in rows(ordering.assign_batches(letters, "key", 0))} == {0}
    total = ordering.with_running_total(letters.withColumn("w", F.ascii("key") - 96), ["key"], "w")
    assert rows(total, "key", "upto") == list(zip("abcdefg", [1, 3, 6, 10, 15, 21, 28]))
    assert rows(selection.pick_rows(letters, [selection.Key("key", descending=True)], [0, 6])) == [("a",), ("g",)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_sample_is_stable(spark, letters, parts):
    df = spark.range(1000).repartition(parts)
    got = rows(ordering.sample_n(df, 20, ["id"], seed=3))
    assert len(set(got)) == 20
    assert got == rows(ordering.sample_n(spark.range(1000), 20, ["id"], seed=3))
    assert got != rows(ordering.sample_n(df, 20, ["id"], seed=4))


@pytest.mark.parametrize("skip,left", [
    ([], "AAPL MSFT GOOGL TSLA"), (["msft"], "AAPL GOOGL TSLA"), (["MSFT", "TSla"], "AAPL GOOGL"),
    (["INVALID"], "AAPL MSFT GOOGL TSLA"), (["aapl", "msft", "googl", "tsla"], ""),
])
def test_exclusion_ignores_case(spark, skip, left):
    df = spark.createDataFrame([(k,) for k in ("AAPL", "MSFT", "GOOGL", "TSLA")], "ticker string")
    assert rows(filters.exclude_keys(df, "ticker", skip)) == [(k,) for k in sorted(left.split())]
    listed = spark.createDataFrame([(s,) for s in skip], "x string")
    assert rows(filters.exclude_keys(df, "ticker", listed)) == [(k,) for k in sorted(left.split())]


@pytest.mark.parametrize("text,hours", [("today", 0), ("today-24h", 24), ("today-168h", 168), ("today-1h30m", 1.5)])
def test_relative_date(spark, text, hours):
    now = dt.datetime(2024, 5, 3, 1, 0)
    got = spark.range(1).select(scalars.relative_date(text, F.lit(now).cast("timestamp_ntz"))).first()[0]
    assert got == (now - dt.timedelta(hours=hours)).date()


@pytest.mark.parametrize("text,message", [
    ("noon", "is neither today nor"), ("sunday-48h", "does not begin with today"),
    ("today-soon", "is no duration"), ("today-7", "is no duration"),
])
def test_relative_date_rejects(spark, text, message):
    with pytest.raises(ValueError, match=message):
        scalars.relative_date(text)


def test_universe_precedence(spark):
    df = spark.createDataFrame([
        ("a", "NYSE", "Stock", D("1999-01-01")), ("b", "NYSE", "ETF", D("1999-01-01")),
        ("c", "NASDAQ", "Stock", D("2002-09-30")), ("d", "NASDAQ", "Stock", D("2002-10-01")),
        ("e", "NASDAQ", "ETF", D("2003-01-01")), ("f", "AMEX", "Stock", D("2003-01-01")),
    ], "t string, exchange string, assetType string, date date")
    assert rows(filters.training_universe(df), "t") == [("a",), ("d",), ("e",)]
    assert rows(filters.training_universe(df, strict=True), "t") == [("a",), ("d",)]
    kept = rows(filters.training_members(df), "t")
    assert set(rows(filters.training_universe(df), "t")) <= set(kept) == {("a",), ("c",), ("d",), ("e",)}


def test_filters(spark):
    df = spark.createDataFrame([(D("2024-02-16"), 1), (D("2024-02-17"), 0), (D("2024-03-20"), 2)], "date date, quarter int")
    assert rows(filters.calendar_filter(df), "date") == [(D("2024-02-17"),)]
    assert filters.drop_annual(df).count() == 2
    as_of = F.lit("2024-03-21").cast("date")
    assert filters.lookback(df, "date", 1, as_of).count() == 1
    assert filters.lookback(df, "date", 0, as_of).count() == 3
    assert filters.facet_filter(df, {"quarter": []}).count() == 3
    assert filters.since(df, "date", "2024-02-17").count() == 2
    assert filters.since(df, "date", "2024-02-17", inclusive=False).count() == 1
    with pytest.raises(ValueError, match="nothing"):
        filters.require_rows(df.where("false"), "nothing")
    with pytest.raises(ValueError, match="missing"):
        filters.select_except(df, ["other"])


def test_types_are_normalised(spark):
    df = spark.sql("select cast(1.5 as decimal(18,3)) d, cast(null as string) s, 'x' t, 3 i")
    out = filters.normalise_types(df)
    assert dict(out.dtypes)["d"] == "double" and rows(out) == [(1.5, "None", "x", 3)]


def test_scalar_edges(spark):
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0), (1.0, 0.0), (None, 1.0), (-1.0, -1.0)], "a double, b double")
    got = [r[0] for r in df.select(macros.excess_return("a", "b")).collect()]
    assert got[0] == pytest.approx(math.log(2)) and got[1:] == [None] * 4
    macros.register_sql_functions(spark)
    assert spark.sql("select excess_return(2, 1)").first()[0] == pytest.approx(math.log(2))
    m, v = 0.3, 0.04
    std = spark.range(1).select(
        scalars.predicted_std(F.lit(m), F.lit(v)), scalars.predicted_std(F.lit(m), F.lit(v), "stored"),
    ).first()
    assert std[0] == pytest.approx(math.exp(m) * 0.2)
    assert std[1] == pytest.approx(math.sqrt(math.exp(m) * 2 * v))
    with pytest.raises(ValueError):
        scalars.predicted_std("a", "b", "other")
    label = spark.createDataFrame([("excess_return_ln_36m",), ("none",)], "p string")
    assert rows(label.select(scalars.horizon_label("p"), scalars.horizon_months("p"))) == [
        ("36m", 36), ("one", None),
    ]


def test_jitter_stays_in_range(spark):
    day = F.lit("2024-01-01").cast("date")
    out = spark.range(500).select("id", scalars.jittered(day, "id").alias("j"))
    low, high = out.agg(F.min("j"), F.max("j")).first()
    assert dt.datetime(2023, 12, 12) <= low < dt.datetime(2023, 12, 14)
    assert dt.datetime(2024, 1, 19) < high < dt.datetime(2024, 1, 21)


def test_pivots(spark):
    df = spark.createDataFrame([("a", 1, "x", 2.0), ("a", 1, "x", 3.0), ("a", 1, "y", 4.0), ("b", 1, None, 5.0)],
                               "k string, d int, m string, v double")
    wide = reshape.pivot_sum(df, "m", "v", ["k"])
    assert wide.columns == ["k", "x", "y"] and rows(wide) == [("a", 5.0, 4.0), ("b", None, None)]
    fixed = reshape.pivot_sum(df, "m", "v", ["k"], ["y", "z"])
    assert rows(fixed) == [("a", 4.0, None), ("b", None, None)]
    several = reshape.pivot_multi(df.where("v > 2"), "m", ["x", "y"], ["d"], ["v", "k"], order="v")
    assert several.columns == ["d", "x_v", "x_k", "y_v", "y_k"]
    assert rows(several) == [(1, 3.0, "a", 4.0, "a")]


def test_open_ended_pivot(spark):
    df = spark.createDataFrame([("a", "x", 2.0), ("a", "x", 3.0), ("a", "y", None), ("b", None, 5.0), (None, "z", 1.0)],
                               "k string, m string, v double")
    wide = reshape.pivot_map(df, "m", "v", ["k"])
    assert {r["k"]: r["metrics"] for r in wide.collect()} == {"a": {"x": 5.0, "y": None}, "b": {}, None: {"z": 1.0}}
    assert rows(reshape.map_columns(wide, ["z", "x"])) == [("a", None, 5.0), ("b", None, None), (None, 1.0, None)]
    assert reshape.pivot_map(df.limit(0), "m", "v", ["k"]).count() == 0
    many = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.concat(F.lit("m"), F.col("id") % 20_000).alias("m"), F.lit(1).alias("v"))
    got = reshape.pivot_map(many, "m", "v", ["k"])
    assert rows(got.select("k", F.size("metrics"))) == [(0, 20_000), (1, 20_000), (2, 20_000)]
    assert rows(reshape.map_columns(got, ["m19999", "m20000"])) == [(0, 1, None), (1, 1, None), (2, 1, None)]


def test_profile_and_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "c"), (4.0, "d"), (None, "e")], "v double, s string")
    assert rows(reshape.profile_table(df)) == [(5, 0, "v", "double", 1), (5, 1, "s", "string", 1)]
    for accuracy in (None, 1000):
        d = reshape.describe(df, ["v"], accuracy).first()
        assert (d["count"], d["null_count"], d["mean"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (
            4, 1, 2.5, 1.0, 1.0, 2.0, 3.0, 4.0,
        )
    assert d["std"] == pytest.approx(1.2909944487)


def test_summary_history_is_in_date_order(spark):
    df = spark.createDataFrame([("a", D("2024-01-03"), 3.9), ("a", D("2024-01-01"), -1.9), ("a", D("2024-01-02"), 2.0)],
                               "ticker string, date date, v double")
    assert rows(reshape.series_summary(df, "ticker", "date", "v")) == [
        ("a", D("2024-01-03"), 3.9, [-1, 2, 3], "https://finance.yahoo.com/quote/a"),
    ]
    with pytest.raises(ValueError, match="DATE"):
        reshape.series_summary(df.withColumn("date", F.col("date").cast("timestamp")), "ticker", "date", "v")


def test_joins(spark):
    a = spark.createDataFrame([("AAPL", 1), ("MSFT", 2), ("TSLA", 3)], "t string, v int")
    b = spark.createDataFrame([("aapl", "x"), ("msft", "y"), ("msft", "z")], "t string, w string")
    assert rows(joins.semi_join_upper(a, b, "t", "t"), "t") == [("AAPL",), ("MSFT",)]
    assert len(rows(joins.left_join_upper(a, b, "t", "t"))) == 4
    assert rows(joins.anti_join(a, a.where("v = 1"), ["t"]), "t") == [("MSFT",), ("TSLA",)]
    assert rows(joins.with_scalar(a, F.max("v"), "top"), "v", "top") == [(1, 3), (2, 3), (3, 3)]
    assert rows(setops.shared_keys(a, a.where("v > 1"), "t")) == [("MSFT",), ("TSLA",)]
    assert rows(setops.missing_keys(a, a.where("v > 1"), "t")) == [("AAPL",)]
    with pytest.raises(ValueError, match="calendar"):
        joins.join_calendar(a, a, "v")


def test_scalar_max_is_pushed_into_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = filters.latest_only(df, "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderdate,ScalarSubquery" in plan and "Cartesian" not in plan
    assert "NestedLoop" not in plan


def test_top_rows_are_sorted_in_parts_that_follow_the_rows(spark, monkeypatch):
    """A group larger than a part is cut, with the same result, and no task sorts a share of the whole table."""
    monkeypatch.setattr(ordering, "PART_ROWS", 100)
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"), "id", ((F.col("id") * 37) % 211 - 100).cast("double").alias("v"))
    got = ordering.top_by_magnitude(df, ["g"], "v", 3, [F.col("id").asc()])
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    groups = {}
    for g, i, v in df.collect():
        groups.setdefault(g, []).append((-abs(v), i))
    want = sorted((g, i, k + 1) for g, held in groups.items() for k, (_, i) in enumerate(sorted(held)[:3]))
    assert sorted(tuple(r) for r in got.select("g", "id", "rank").collect()) == want
