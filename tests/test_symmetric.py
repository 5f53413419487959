"""Symmetric trees: splits, uncertainty, the validation curve, exact contributions, storage."""

from __future__ import annotations

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.functions.scalars import hash_unit
from quantloom.models import boosting, symmetric, uncertainty
from quantloom.models.symmetric import Ensemble, Tree

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def noisy(spark):
    """The mean follows ``a``, the deviation ``b``; ``c`` says nothing and is often missing."""
    rng = random.Random(7)
    rows = []
    for k in range(3000):
        a, b = rng.random(), rng.random()
        y = (2.0 if a > 0.5 else -1.0) + rng.gauss(0, 2.0 if b > 0.7 else 0.3)
        c = None if k % 5 == 0 else math.nan if k % 7 == 0 else rng.random()
        rows.append((k, a, b, c, y, k % 4 == 0, k % 4 == 1))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double, held boolean, test boolean").repartition(3).cache()


@pytest.fixture(scope="module")
def model(noisy):
    return symmetric.fit(noisy.where("not test"), "y", NAMES, F.col("held"), iterations=30, depth=2, rate=0.3, borders=[[0.25, 0.5, 0.75], [0.3, 0.5, 0.7], [0.5]])


def likelihood(df, mean, variance):
    return df.select(F.avg(0.5 * (F.ln(2 * math.pi * variance) + F.pow(F.col("y") - mean, 2) / variance))).first()[0]


def test_mean_and_deviation_are_found_on_rows_not_seen(noisy, model):
    scored = symmetric.predict(noisy.where("test"), model, ["id", "a", "b", "y"])
    found = {tuple(r[:2]): r[2:] for r in scored.groupBy(F.col("a") > 0.5, F.col("b") > 0.7).agg(F.avg("prediction"), F.avg(F.sqrt("variance"))).collect()}
    for (high, wide), (mean, deviation) in found.items():
        assert mean == pytest.approx(2.0 if high else -1.0, abs=0.3)
        assert deviation == pytest.approx(2.0 if wide else 0.3, rel=0.35)
    joint = likelihood(scored, F.col("prediction"), F.col("variance"))
    flat = noisy.where("not test and not held").select(F.var_pop(F.col("y") - F.when(F.col("a") > 0.5, 2.0).otherwise(-1.0))).first()[0]
    # better than the true mean with one deviation for all
    assert joint < likelihood(scored, F.when(F.col("a") > 0.5, 2.0).otherwise(-1.0), F.lit(flat)) - 0.3


def test_the_curve_has_its_minimum_at_the_best_iteration(spark, model):
    rows = symmetric.curve_table(model, spark).collect()
    values = [r["negative_log_likelihood"] for r in rows]
    assert [r["iteration"] for r in rows] == list(range(len(rows))) and rows[0]["rows"] == 750
    assert values.index(min(values)) == model.best_iteration == [r["is_best"] for r in rows].index(True) == len(model.trees)


@pytest.mark.parametrize("errors, patience, want", [
    ([], 3, (0, False)), ([5.0], 3, (0, False)), ([5, 4, 4.5, 4.4, 3.9], 3, (4, False)), ([5, 4, 4.5, 4.4, 4.3], 3, (1, True)), ([5, 4, 4, 4], 2, (1, True)),
])
def test_patience_on_noisy_curves(errors, patience, want):
    assert symmetric.best_round(errors, patience) == want


def test_boosting_stops_and_goes_back_to_the_best_round(spark):
    """The validation rows contradict the training rows, so the first rounds are the best ones."""
    rng = random.Random(1)
    rows = [(x := rng.random(), (x if k % 2 else -x) + rng.gauss(0, 0.1), k % 2 == 0) for k in range(600)]
    df = spark.createDataFrame(rows, "a double, y double, held boolean")
    out = symmetric.fit(df, "y", ["a"], F.col("held"), iterations=40, depth=1, patience=3, n_borders=8)
    assert len(out.curve) < 20 and len(out.curve) - 1 - out.best_iteration == 3


def test_state_written_again_changes_nothing(noisy, monkeypatch):
    rows = noisy.where("id < 600")
    options = dict(iterations=7, depth=2, n_borders=8, patience=99)
    want = symmetric.fit(rows, "y", NAMES, F.col("held"), **options)
    monkeypatch.setattr(symmetric, "REFRESH", 2)
    got = symmetric.fit(rows.repartition(5), "y", NAMES, F.col("held"), **options)
    assert [t.splits for t in got.trees] == [t.splits for t in want.trees] and got.borders == want.borders
    assert np.allclose([t.leaves for t in got.trees], [t.leaves for t in want.trees])


def walk(tree, row, inside, level=0, node=0, outside=None):
    """The expected step of a tree, followed node by node."""
    depth = len(tree.splits)
    if level == depth:
        return np.array(tree.leaves[node])
    f, b = tree.splits[level]
    if f in inside:
        return walk(tree, row, inside, level + 1, node * 2 + int(row[f] > b))
    size = 1 << (depth - 1 - level)
    left, right = (sum(tree.covers[c * size : (c + 1) * size]) for c in (node * 2, node * 2 + 1))
    share = left / (left + right) if left + right else 0.5
    return share * walk(tree, row, inside, level + 1, node * 2) + (1 - share) * walk(tree, row, inside, level + 1, node * 2 + 1)


def test_contributions_equal_all_coalitions_of_six_features(spark):
    rng = random.Random(11)
    names = [f"f{k}" for k in range(6)]
    trees = []
    for depth in (1, 2, 3, 4, 5, 6, 6):
        splits = [(rng.randrange(6), rng.randrange(0, 4)) for _ in range(depth)]
        trees.append(Tree(splits, [(rng.gauss(0, 1), rng.gauss(0, 0.2)) for _ in range(1 << depth)], [rng.choice([0, 1, 5, 40]) for _ in range(1 << depth)]))
    own = Ensemble(names, [[0.2, 0.5, 0.8]] * 6, (0.3, -0.1), trees)
    rows = [(k, *[None if rng.random() < 0.1 else rng.random() for _ in names]) for k in range(12)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names))
    got = {r["id"]: r for r in symmetric.predict(df, own, ["id"]).collect()}
    for k, *values in rows:
        bins = [0 if v is None else 1 + sum(c < v for c in (0.2, 0.5, 0.8)) for v in values]
        value = {frozenset(c): sum((walk(t, bins, c) for t in trees), np.array(own.start)) for n in range(7) for c in combinations(range(6), n)}
        for f in range(6):
            rest = [i for i in range(6) if i != f]
            want = sum(
                (value[frozenset(c) | {f}] - value[frozenset(c)]) * math.factorial(n) * math.factorial(5 - n) / math.factorial(6)
                for n in range(6) for c in combinations(rest, n)
            )
            assert (got[k]["contributions"][f], got[k]["log_deviation_contributions"][f]) == pytest.approx(tuple(want), abs=1e-9)
        assert got[k]["bias"] + sum(got[k]["contributions"]) == pytest.approx(got[k]["prediction"], abs=1e-9)
        assert 2 * (got[k]["log_deviation_bias"] + sum(got[k]["log_deviation_contributions"])) == pytest.approx(math.log(got[k]["variance"]), abs=1e-9)


def test_the_bias_is_the_expected_prediction_over_training_rows(noisy):
    """Exactly so for trees of one level."""
    out = symmetric.fit(noisy, "y", NAMES, F.lit(False), iterations=5, depth=1, n_borders=8)
    scored = symmetric.predict(noisy, out, ["id"])
    mean, low, high = scored.agg(F.avg("prediction"), F.min("bias"), F.max("bias")).first()
    assert low == high == pytest.approx(mean, abs=1e-9) and len(out.trees) == 5 and out.curve == []


def test_a_stored_model_scores_alike(spark, noisy, model, scratch):
    symmetric.save(model, spark, f"{scratch.path}/model")
    again = symmetric.load(spark, f"{scratch.path}/model")
    assert again == model
    first, second = (symmetric.predict(noisy, m, ["id"]).where("id < 50").collect() for m in (model, again))
    assert sorted(first) == sorted(second)


def test_no_rows_no_features_and_equal_targets(spark, noisy):
    empty = symmetric.fit(noisy.limit(0), "y", NAMES, F.col("held"), iterations=3)
    assert empty.trees == [] and symmetric.predict(noisy.limit(0), empty, ["id"]).collect() == []
    constant = symmetric.fit(noisy.withColumn("y", F.lit(4.0)), "y", NAMES, F.col("held"), iterations=3, depth=1)
    assert symmetric.predict(noisy.limit(2), constant, ["id"]).select("prediction").distinct().collect()[0][0] == pytest.approx(4.0)
    none = symmetric.fit(noisy, "y", [], F.col("held"), iterations=3)
    assert none.trees == [] and symmetric.predict(noisy.limit(1), none, ["id"]).count() == 1
    with pytest.raises(ValueError, match="borders"):
        symmetric.fit(noisy, "y", NAMES, F.col("held"), n_borders=300)


# ---- horizon models ---------------------------------------------------------------------------


def panel_rows(spark, seed):
    """Returns that follow the sector and whose spread follows ``risk``."""
    rng = random.Random(seed)
    means = {"x": 0.4, "y": -0.4, None: 0.0}
    rows = []
    for k in range(2500):
        sector, risk = rng.choice(list(means)), rng.random()
        rows.append((f"T{k % 50}", f"2001-01-{k // 50:02d}x", sector, risk, means[sector] + rng.gauss(0, 1.0 if risk > 0.5 else 0.1)))
    return spark.createDataFrame(rows, "ticker string, date string, sector string, risk double, excess_return_ln_12m double").repartition(2).cache()


@pytest.fixture(scope="module")
def panel(spark):
    return panel_rows(spark, 4)


def test_joint_models_beat_two_separate_ones_on_rows_not_seen(spark, panel, scratch):
    target = "excess_return_ln_12m"
    joint = uncertainty.train_uncertainty(panel, target, 3, 40, depth=2, rate=0.3, n_borders=16)
    apart = boosting.train_horizon(panel, target, 3, 8)
    test = boosting.split(panel, 3).where("split = 'test'")
    fresh, loss = panel_rows(spark, 5), {}
    for name, own in (("joint", joint), ("apart", apart)):
        scored = boosting.score(fresh, own).withColumn("y", F.col("actual_value_log"))
        loss[name] = likelihood(scored, F.col("predicted_value_log"), F.col("variance"))
    assert loss["joint"] < loss["apart"], loss
    shares = boosting.attributions(test, joint)
    assert shares.columns == ["ticker", "date", "shap_sector", "shap_risk", "bias"]
    gap = shares.join(boosting.score(test, joint), ["ticker", "date"]).select(F.max(F.abs(F.col("shap_sector") + F.col("shap_risk") + F.col("bias") - F.col("predicted_value_log"))))
    assert gap.first()[0] < 1e-9
    assert boosting.feature_importance(joint, test).first()["feature"] == "sector"
    facts = uncertainty.training_statistics(panel, joint).first()
    assert facts["n_test"] == test.count() and facts["n_rows"] == 2500 and 0 < facts["test_r2"] < 1 and facts["test_rmse"] > 0 and facts["test_mape"] > 0
    uncertainty.save_model(joint, spark, f"{scratch.path}/joint")
    again = uncertainty.load_model(spark, f"{scratch.path}/joint")
    pick = ["ticker", "date", "predicted_value_log", "variance"]
    assert sorted(boosting.score(test, again).select(pick).collect()) == sorted(boosting.score(test, joint).select(pick).collect())
    assert again.trained_at == joint.trained_at and again.features == joint.features


def test_ordered_means_leave_out_the_own_target_and_survive_slices(spark, panel):
    rows = [tuple(r) for r in panel.select("ticker", "date", "sector", "excess_return_ln_12m").collect()]
    small = panel.select("ticker", "date", F.col("sector").alias("c"), F.col("excess_return_ln_12m").alias("y"))
    found = []
    for limit in (None, 5000, 300):
        out = uncertainty.ordered_target_mean(small, "c", "y", ["ticker", "date"], 5, 0.25, "m", max_group_rows=limit)
        assert out.columns == ["ticker", "date", "c", "y", "m"]
        found.append({(r["ticker"], r["date"]): r["m"] for r in out.collect()})
    order = {tuple(r[:2]): r[2] for r in small.select("ticker", "date", hash_unit("ticker", "date", seed=5)).collect()}
    sums: dict = {}
    for ticker, date, c, y in sorted(rows, key=lambda r: (order[r[:2]], r[:2])):
        total, n = sums.get(c, (0.0, 0))
        for values in found:
            assert values[ticker, date] == pytest.approx((total + 0.25) / (n + 1), abs=1e-9)
        sums[c] = total + y, n + 1
