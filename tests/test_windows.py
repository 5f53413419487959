"""Windowed operators against brute force, with ordinary and with hot keys."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.functions import macros
from quantloom.operators import windows
from quantloom.operators.joins import asof_join, join_calendar
from quantloom.operators.skew import HotKeys, find_hot_keys, with_exact_row_number, with_slices
from quantloom.operators.windows import Rolling

SKEWED = {"hot": 400, "warm": 40, "one": 1, "exact": 6, "short": 5}


@pytest.fixture(scope="module")
def series(spark):
    draw = random.Random(1)
    data = []
    for key, n in SKEWED.items():
        t = 0
        for _ in range(n):
            t += draw.choice([1, 1, 2, 50])
            value = None if draw.random() < 0.1 else round(draw.uniform(1, 100), 2)
            data.append((key, t, value))
    draw.shuffle(data)
    return data


def _frame(spark, series):
    return spark.createDataFrame(series, "key string, t int, v double").repartition(7)


def _by_key(series):
    out = {}
    for key, t, v in sorted(series, key=lambda r: (r[0], r[1])):
        out.setdefault(key, []).append((t, v))
    return out


@pytest.mark.parametrize("limit", [None, 10_000, 37, 6])
@pytest.mark.parametrize("periods", [5, 12])
def test_rolling_moments(spark, series, limit, periods):
    got = windows.rolling_moments(
        _frame(spark, series), "key", "t",
        [Rolling(periods, {"mean": "v"}, {"dev": "v"}), Rolling(2, means={"short": "v"})],
        max_group_rows=limit,
    )
    found = {(r["key"], r["t"]): (r["mean"], r["dev"], r["short"]) for r in got.collect()}
    assert len(found) == len(series)

    def close(a, b):
        return (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)

    for key, points in _by_key(series).items():
        for i, (t, _) in enumerate(points):
            def frame(n):
                return [v for _, v in points[max(0, i - n):i + 1] if v is not None]

            mean = statistics.fmean(frame(periods)) if i >= periods and frame(periods) else None
            dev = statistics.stdev(frame(periods)) if i >= periods and len(frame(periods)) > 1 else None
            short = statistics.fmean(frame(2)) if i >= 2 and frame(2) else None
            for a, b in zip(found[key, t], (mean, dev, short)):
                assert close(a, b), (key, t)


def test_a_flat_stretch_after_a_crash_is_flat(spark):
    """Cancellation stays below a ten-millionth of the jump."""
    df = spark.range(400).select(F.lit("k").alias("key"), F.col("id").alias("t"),
                                 F.when(F.col("id") < 90, 1e6).otherwise(0.1).alias("v"))
    got = windows.rolling_moments(df, "key", "t", [Rolling(50, {"m": "v"}, {"d": "v"})])
    tail = got.where("t >= 141").agg(F.max("d"), F.max(F.abs(F.col("m") - 0.1))).first()
    assert tail[0] < 1e6 * 1e-7 and tail[1] < 1e-8


def test_macro_equals_operator(spark, series):
    df = _frame(spark, series).where("v is not null")
    macro = df.select("key", "t", F.round(macros.sma("v", "key", "t", 5), 9).alias("m"))
    op = windows.with_sma(df, "v", "key", "t", 5, "m").select("key", "t", F.round("m", 9).alias("m"))
    assert rows(macro) == rows(op)


@pytest.mark.parametrize("limit", [None, 25, 4])
def test_future_return_and_development(spark, series, limit):
    df = _frame(spark, series).na.fill(0.0).withColumn("idx", F.col("t") + 1.0)
    got = windows.with_future_return(df, "v", "key", "t", 3, "ahead", max_group_rows=limit)
    got = windows.with_relative_development(got, "v", "idx", "key", "t", "dev", max_group_rows=limit)
    found = {(r["key"], r["t"]): (r["ahead"], r["dev"]) for r in got.collect()}
    for key, points in _by_key([(k, t, v or 0.0) for k, t, v in series]).items():
        for i, (t, v) in enumerate(points):
            ahead = points[i + 3][1] / v if i + 3 < len(points) and v else None
            dev = None
            if i and points[i - 1][1]:
                dev = (v / points[i - 1][1]) / ((t + 1.0) / (points[i - 1][0] + 1.0)) or None
            for a, b in zip(found[key, t], (ahead, dev)):
                assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9), (key, t)


def test_short_deviation_of_one_row_is_null(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0)], "key string, t int, v double")
    got = windows.with_short_deviation(df, "v", "key", "t", 4, "d")
    assert rows(got, "t", F.round("d", 6)) == [(1, None), (2, 1.414214)]


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 4.0, 0.0)], "key string, t int, v double, x double")
    got = windows.with_index_volatility(df, "v", "x", "key", "t", 1, "vol")
    assert rows(got, "vol") == [(None,), (None,)]
    assert rows(windows.with_future_return(df, "v", "key", "t", 1, "r"), "r") == [(None,), (None,)]


@pytest.mark.parametrize("limit", [None, 1000, 30, 3])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_join(spark, limit, how):
    draw = random.Random(2)
    keys = ["hot"] * 8 + ["b", "c"]
    left = [(draw.choice(keys), draw.randrange(200) if draw.random() > 0.03 else None, i) for i in range(300)]
    right = [(draw.choice([*keys, "only"]), draw.randrange(200), i) for i in range(120)]
    right += [("hot", None, 500), (None, 5, 501)]
    left += [(None, 10, 900)]
    l_df = spark.createDataFrame(left, "key string, t int, id int").repartition(5)
    r_df = spark.createDataFrame(right, "key string, t int, payload int").repartition(3)
    got = asof_join(l_df, r_df, ["key"], "t", "t", how=how, tie_break=["payload"], max_group_rows=limit)
    assert got.columns == ["key", "t", "id", "t_right", "payload"]
    want = []
    for key, t, i in left:
        before = [(rt, p) for k, rt, p in right
                  if key is not None and t is not None and k == key and rt is not None and rt <= t]
        if before:
            want.append((key, t, i, *max(before)))
        elif how == "left":
            want.append((key, t, i, None, None))
    assert rows(got) == sorted(want, key=str)


def test_asof_never_looks_ahead(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = asof_join(events.select("user_id", "ts", "event_id"),
                    events.select("user_id", F.col("ts").alias("seen"), F.col("value").alias("last")),
                    ["user_id"], "ts", "seen", tie_break=["last"])
    assert got.where("seen > ts").count() == 0 and got.count() == events.count()


def test_latest_first_and_period(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-31", 1.0), ("a", "2024-02-01", 2.0), ("a", "2024-05-01", 4.0), ("b", "2023-12-31", 5.0)],
        "key string, d string, v double",
    ).withColumn("d", F.col("d").cast("date"))
    assert rows(windows.latest_per_key(df, "key", "d"), "key", "v") == [("a", 4.0), ("b", 5.0)]
    assert rows(windows.first_in_period(df, "key", "d"), "key", "v") == [("a", 1.0), ("a", 4.0), ("b", 5.0)]
    assert rows(windows.relative_to_first(df, "v", "key", "d"), "key", "relative") == [
        ("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 1.0),
    ]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_results_do_not_depend_on_partitioning(spark, series, parts):
    df = spark.createDataFrame(series, "key string, t int, v double").repartition(parts)
    got = windows.rolling_moments(df, "key", "t", [Rolling(4, {"m": "v"}, {"s": "v"})], max_group_rows=50)
    summary = got.agg(F.round(F.sum("m"), 6), F.round(F.sum("s"), 6), F.count("m"), F.count("s")).first()
    assert tuple(summary) == _SUMMARY.setdefault("first", tuple(summary))


_SUMMARY: dict = {}


def test_ordinary_keys_need_one_shuffle(spark, series):
    df = _frame(spark, series)
    out = windows.rolling_moments(df, "key", "t", [Rolling(5, {"m": "v"}), Rolling(9, {}, {"s": "v"})])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_dedupe_reduces_before_the_shuffle(spark, series):
    df = _frame(spark, series)
    plan = windows.latest_per_key(df, "key", "t")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


@pytest.mark.parametrize("limit", [None, 60])
def test_nan_infinity_and_outliers_leave_with_their_row(spark, limit):
    draw = random.Random(7)
    values = [round(draw.uniform(1, 2), 3) for _ in range(200)]
    values[5], values[40], values[90], values[91] = float("nan"), 1e17, float("inf"), float("-inf")
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "key string, t int, v double")
    frames = [Rolling(4, {"m4": "v"}, {"d4": "v"}), Rolling(17, {"m17": "v"}, {"d17": "v"})]
    got = windows.rolling_moments(df, "key", "t", frames, max_group_rows=limit)
    plain = df
    for n in (4, 17):
        spec = W.partitionBy("key").orderBy("t").rowsBetween(-n, 0)
        warm = F.row_number().over(W.partitionBy("key").orderBy("t")) > n
        plain = plain.withColumns({f"m{n}": F.when(warm, F.avg("v").over(spec)), f"d{n}": F.when(warm, F.stddev_samp("v").over(spec))})
    names = ("m4", "d4", "m17", "d17")
    want = {r["t"]: [r[c] for c in names] for r in plain.collect()}
    for r in got.collect():
        for one, other in zip([r[c] for c in names], want[r["t"]]):
            assert (one is None and other is None) or (math.isnan(one) and math.isnan(other)) or math.isclose(one, other, rel_tol=1e-9), (r, want[r["t"]])


def test_one_instant_of_a_hot_key_is_cut(spark):
    df = spark.range(1000).select(F.lit("k").alias("key"), F.lit(5).alias("t"), F.col("id").alias("v"))
    hot = find_hot_keys(df, ["key"], 100)
    sizes = [r["count"] for r in with_slices(df, hot, ["t"]).groupBy("_slice").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 300
    numbered = with_exact_row_number(with_slices(df, hot, ["t"]), hot, [F.col("t")])
    assert sorted(r["_rn"] for r in numbered.collect()) == list(range(1, 1001))
    left = df.select("key", F.col("t").alias("at"), F.col("v").alias("id"))
    got = asof_join(left, df, ["key"], "at", "t", tie_break=["v"], max_group_rows=100)
    assert got.where("v <> 999").count() == 0 and got.count() == 1000


def test_a_low_limit_does_not_ask_for_a_slice_every_few_rows(spark):
    df = spark.range(6000).select((F.col("id") % 150).alias("key"), F.col("id").alias("t"))
    hot = find_hot_keys(df, ["key"], 16)
    assert (hot.n_keys, hot.rows) == (150, 6000)
    sliced = with_slices(df, hot, ["t"])
    assert sliced.rdd.getNumPartitions() <= 64
    numbered = with_exact_row_number(sliced, hot, [F.col("t").asc()])
    assert numbered.where(F.col("_rn") != F.floor(F.col("t") / 150) + 1).count() == 0 and numbered.count() == 6000
    large = HotKeys(df, ["key"], 9_000, 360_000_000, 16)
    assert large.n_slices == 1800  # by size, where that makes more slices
    assert HotKeys(df, ["key"], 1, 10_000_000, 2_000_000).n_slices == 5


def test_a_calendar_day_must_not_occur_twice(spark):
    df = spark.sql("select date '2020-01-01' as d, 1 as x")
    days = spark.sql("select date '2020-01-01' as d, 2.0 as i")
    assert rows(join_calendar(df, days, "d"), "x", "i") == [(1, 2)]
    with pytest.raises(Exception, match="occurs twice"):
        join_calendar(df, days.unionByName(days), "d").collect()
