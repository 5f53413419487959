from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quantloom.models import boosting
from quantloom.plans import predictions

TARGET = "excess_return_ln_12m"


@pytest.fixture(scope="module")
def frame(spark):
    """Tickers by quarter; the target follows one number and one category."""
    base = spark.range(2400).select(
        F.concat(F.lit("T"), (F.col("id") % 60).cast("string")).alias("ticker"),
        F.date_add(F.lit("2014-01-01").cast("date"), (F.floor(F.col("id") / 60) * 91).cast("int")).alias("date"),
        F.lit("Name").alias("name"),
        F.when(F.col("id") % 60 < 30, "tech").otherwise(F.when(F.col("id") % 7 > 0, "bank")).alias("sector"),
        ((F.col("id") * 37) % 101 / 50.0).alias("margin"),
        F.when(F.col("id") % 9 > 0, (F.col("id") * 53) % 97 / 97.0).alias("noise"),
    )
    value = F.when(F.col("sector") == "tech", 0.4).otherwise(-0.1) + F.col("margin") / 2
    recent = F.col("date") > F.lit("2023-06-01").cast("date")
    return base.withColumns({t: F.when(~recent, value) for t in boosting.TARGETS})


@pytest.fixture(scope="module")
def model(frame):
    return boosting.train_horizon(frame, TARGET, seed=1, iterations=12)


def test_training_frame_keeps_only_its_target(frame):
    cols = boosting.training_frame(frame, TARGET).columns
    assert TARGET in cols and "name" not in cols
    assert not {"excess_return_ln_6m", "excess_return_ln_24m", "excess_return_ln_36m"} & set(cols)
    assert boosting.feature_names(frame, TARGET) == ["sector", "margin", "noise"]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_split_is_complete_and_stable(frame, parts):
    marked = boosting.split(frame.repartition(parts), 5)
    counts = dict(rows(marked.groupBy("split").count()))
    assert sum(counts.values()) == frame.count()
    assert 0.015 < counts["test"] / 2400 < 0.05 and 0.03 < counts["validation"] / 2400 < 0.07
    ticket = marked.groupBy("split").agg(F.bit_xor(F.xxhash64("ticker", "date")).alias("h"))
    assert rows(ticket) == rows(boosting.split(frame, 5).groupBy("split").agg(F.bit_xor(F.xxhash64("ticker", "date")).alias("h")))


def test_hyper_parameters():
    assert boosting.sampling("excess_return_ln_6m") == {"subsamplingRate": 0.8, "minInstancesPerNode": 15}
    assert boosting.sampling(TARGET) == {"subsamplingRate": 0.9, "minInstancesPerNode": 10}
    assert boosting.DEPTH == 6 and boosting.LEARNING_RATE == 0.15


def test_model_learns(frame, model):
    report = boosting.evaluate(frame, model).first()
    spread = frame.agg(F.stddev_samp(TARGET)).first()[0]
    assert report["test_rmse"] < 0.3 * spread
    assert report["n_train"] + report["n_validation"] + report["n_test"] == report["n_rows"]
    assert 1 < report["best_iteration"] <= 12
    importance = {r["feature"]: r["importance"] for r in boosting.feature_importance(model, frame).collect()}
    assert importance["noise"] < min(importance["sector"], importance["margin"])
    assert sum(importance.values()) == pytest.approx(1.0)


def test_scores(frame, model):
    scored = boosting.score(frame, model)
    assert scored.count() == frame.count()
    assert scored.where("variance <= 0 or predicted_std <= 0 or predicted_value is null").count() == 0
    assert scored.where("actual_value is null").count() == frame.where(f"{TARGET} is null").count()


def test_contributions_add_up(frame, model):
    some = frame.where("ticker in ('T1', 'T31')")
    shares = boosting.attributions(some, model)
    scored = boosting.score(some, model)
    gap = shares.join(scored, ["ticker", "date"]).select(F.abs(
        F.col("shap_sector") + F.col("shap_margin") + F.col("shap_noise") + F.col("bias")
        - F.col("predicted_value_log"),
    ).alias("g"))
    assert gap.agg(F.max("g")).first()[0] < 1e-9 and gap.count() == some.count()


def test_sampled_orders_also_add_up():
    subsets, weights = boosting._coalitions(6, 4, seed=0)
    for i in range(6):
        assert sum(w[i] for w in weights) == pytest.approx(0.0)
    full = weights[subsets.index((True,) * 6)]
    assert sum(full) == pytest.approx(1.0)
    for s, w in zip(subsets, weights):
        if any(s) and not all(s):
            assert sum(w) == pytest.approx(0.0)


def test_long_predictions(frame, model):
    out = boosting.latest_predictions(frame, model)
    assert out.count() == 60 * 3
    assert dict(out.dtypes)["trained_at"] == "timestamp_ntz"
    assert out.where("sector" == F.col("feature")).where("feature_value = 'None'").count() > 0
    since = boosting.latest_predictions(frame, model, start="2023-01-01")
    assert since.select("date").distinct().count() > 1
    with pytest.raises(ValueError, match="no rows from"):
        boosting.latest_predictions(frame, model, start="2099-01-01")


def test_explain_one_key(frame, model):
    one = boosting.explain_key(frame, model, "t5")
    assert one.count() == 3 and one.select("ticker").distinct().first()[0] == "T5"
    with pytest.raises(ValueError, match="not found"):
        boosting.explain_key(frame, model, "NONE")
    history = boosting.key_history(frame, model, "t5", "2019-01-01")
    assert history.columns == ["predicted_excess_return", "predicted_std", "ticker", "date", "actual_excess_return"]
    dates = [r["date"] for r in history.collect()]
    assert dates == sorted(dates, reverse=True) and min(dates) > dt.date(2019, 1, 1)


def test_train_all_and_relevant(spark, frame):
    models = boosting.train_all(frame, iterations=2)
    assert list(models) == list(boosting.TRAINED_TARGETS)
    out = boosting.all_predictions(frame, models)
    assert out.select("pred_col").distinct().count() == 3
    meta = spark.createDataFrame(
        [("1", "t1", "One", True), ("2", "t1", "Old", False), ("3", "t2", "Two", False)],
        "permaTicker string, ticker string, name string, isActive boolean",
    ).selectExpr("*", "'s' sector", "'i' industry", "'x' sicSector", "'l' location",
                 "date '2024-01-01' statementLastUpdated")
    kept = predictions.relevant_preds(out, meta)
    assert rows(kept.select("ticker", "name").distinct()) == [("T1", "One")]
    assert predictions.preds_per_horizon(kept).count() == 3
    assert predictions.forecasts(kept, ["t1"], jitter_days=20).count() == 3


def test_missing_values_do_not_shift_the_baseline(frame, model):
    noise = model.baseline[model.features.index("noise")]
    assert 0.4 < noise < 0.6
    bias = boosting.attributions(frame.where("ticker = 'T1'"), model).first()["bias"]
    low, high = boosting.score(frame, model).agg(F.min("predicted_value_log"), F.max("predicted_value_log")).first()
    assert low <= bias <= high


def test_a_category_of_every_row_teaches_nothing(spark):
    """Encoded out of fold, a column with as many values as rows is no leak of the target."""
    rows_ = spark.range(1500).select(
        F.concat(F.lit("T"), F.col("id") % 50).alias("ticker"),
        F.date_add(F.lit("2014-01-01").cast("date"), F.floor(F.col("id") / 50).cast("int")).alias("date"),
        F.lit("n").alias("name"), F.col("id").cast("string").alias("code"), ((F.col("id") * 37) % 101 / 50.0).alias("margin"),
    )
    value = F.col("margin") / 2 + (F.crc32("code") % 1000) / 1000.0
    learned = boosting.train_horizon(rows_.withColumns({t: value for t in boosting.TARGETS}), TARGET, seed=2, iterations=8)
    weights = dict(zip(learned.features, learned.mean.featureImportances.toArray()))
    assert weights["margin"] > 0.9
    scored = boosting.split(boosting.training_frame(rows_.withColumns({t: value for t in boosting.TARGETS}), TARGET), 2).where("split = 'test'")
    band = boosting.score(scored, learned).select(F.avg((F.abs(F.col("actual_value_log") - F.col("predicted_value_log")) <= 2 * F.sqrt("variance")).cast("double")))
    assert band.first()[0] > 0.8


def test_the_training_job_fills_a_table_that_is_pruned(spark, scratch, frame, model):
    path = f"{scratch.path}/predictions"
    boosting.create_predictions(spark, path)
    assert spark.read.parquet(path).count() == 0
    old = boosting.latest_predictions(frame, model).withColumn("trained_date", F.lit("2020-02-02").cast("date"))
    boosting.publish_predictions(old, path)
    boosting.train_and_publish(frame.where("ticker in ('T1', 'T2')"), path, targets=[TARGET], iterations=2)
    table = spark.read.parquet(path)
    assert dict(table.dtypes)["shap_value"] == "float" and table.select("trained_date").distinct().count() == 2
    meta = spark.sql("select 't1' as ticker, true as isActive, 'N' as name, 's' as sector, 'i' as industry, 'x' as sicSector, 'l' as location, date '2020-01-01' as statementLastUpdated, 1 as permaTicker")
    got = predictions.relevant_preds(table, meta, one_company=False)
    assert {r["trained_date"] for r in got.collect()} == {table.agg(F.max("trained_date")).first()[0]}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trained_date" in plan
