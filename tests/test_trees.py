from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.bindings.catalog import REGISTRY
from quantloom.models import boosting, trees

BORDERS = [np.array([-1e30, 2.0, 5.0, 7.0]), np.array([-1e30, 10.0, 20.0, 30.0])]


def grown(x, y, rounds, depth, rate, min_rows):
    """Predictions after ``rounds`` trees, each node split by looking at all borders."""
    def descend(rows, rest, left):
        best, found = 0.0, None
        for f in range(x.shape[1]) if left else ():
            for cut in BORDERS[f]:
                high = rows & (x[:, f] > cut)
                low = rows & ~high
                if min(high.sum(), low.sum()) >= min_rows:
                    gain = sum(rest[s].sum() ** 2 / s.sum() for s in (low, high)) - rest[rows].sum() ** 2 / rows.sum()
                    if gain > best * (1 + 1e-9) + 1e-9:
                        best, found = gain, (low, high)
        if found is None:
            return np.where(rows, rest[rows].mean(), 0.0)
        return sum(descend(side, rest, left - 1) for side in found)

    total, everything = np.zeros(len(y)), np.ones(len(y), bool)
    for k in range(rounds):
        total += rate * descend(everything, 2 * (y - total), depth) if k else descend(everything, y, depth)
    return total


@pytest.mark.parametrize("parts", [1, 5])
def test_trees_equal_brute_force(spark, parts):
    draw = np.random.default_rng(3)
    x = np.stack([draw.integers(0, 10, 400).astype(float), draw.integers(0, 40, 400).astype(float)], axis=1)
    x[draw.random(400) < 0.1, 0] = -1e30
    y = np.where(x[:, 0] > 5, x[:, 1], 20 - x[:, 0].clip(-3)) + draw.normal(size=400)
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(np.column_stack([x, y]).tolist())], "id long, a double, b double, y double").repartition(parts)
    blocks = trees.pack(df, ["a", "b"], BORDERS, F.xxhash64("id"), F.col("y"), [F.lit(trees.TRAINING)])
    model, = trees.boost(blocks, BORDERS, 1, iterations=6, depth=3, rate=0.15, min_rows=10)
    assert len(model.trees) == 6  # past a refresh of the blocks
    assert model.predict(model.bins(x)) == pytest.approx(grown(x, y, 6, 3, 0.15, 10), abs=1e-9)


def test_a_model_grows_alone_as_in_passes(spark):
    draw = np.random.default_rng(5)
    x = np.stack([draw.integers(0, 10, 600), draw.integers(0, 40, 600)], axis=1).astype(float)
    y = x[:, 0] * (x[:, 1] > 15) + draw.normal(size=600)
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(np.column_stack([x, y]).tolist())], "id long, a double, b double, y double").repartition(3)
    roles = [F.when(F.col("id") % 5 == 0, trees.VALIDATION).when(own, trees.TRAINING).otherwise(trees.UNUSED) for own in (F.lit(True), F.col("id") % 2 == 1)]
    blocks = trees.pack(df, ["a", "b"], BORDERS, F.xxhash64("id"), F.col("y"), roles)
    both = [trees.boost(blocks, BORDERS, 2, iterations=7, depth=3, rate=0.15, share=0.9, min_rows=5, seed=2, patience=3, alone=n) for n in (0, 600)]
    for one, other in zip(*both):
        assert len(one.trees) == len(other.trees) > 0
        assert one.errors == pytest.approx(other.errors, rel=1e-9)
        assert one.predict(one.bins(x)) == pytest.approx(other.predict(other.bins(x)), abs=1e-9)


@pytest.mark.parametrize("errors, patience, want", [
    ([3.0, 2.0, 2.5], 0, (2, True)), ([3.0, 2.0, 2.0], 0, (2, False)), ([3.0, 2.0, 2.5], 2, (2, False)), ([3.0, 2.0, 2.5, 2.0], 2, (2, True)), ([3.0, 2.0, 2.5, 1.0], 2, (4, False)),
])
def test_patience_outlives_a_rise(errors, patience, want):
    assert trees.best_count(errors, patience) == want


@pytest.mark.parametrize("query, n_models", [("train_and_evaluate", 1), ("train_all", 3)])
def test_training_queries_train_as_in_production(spark, monkeypatch, query, n_models):
    """2000 trees are allowed, and 25 without a smaller error end it; not the six of queries that need just some model."""
    asked, train = [], boosting.train_horizon
    monkeypatch.setattr("quantloom.bindings.learning._MODELS", {})
    monkeypatch.setattr(boosting, "train_horizon", lambda df, target, seed, iterations, patience: asked.append((iterations, patience)) or train(df, target, seed, 1))
    numbers = {c: (F.col("id") % n).cast("double") for c, n in (("quantity", 7), ("money", 11), ("discount", 3), ("tax", 5))}
    samples = spark.range(300).select(
        F.concat(F.lit("T"), F.col("id") % 20).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / 20).cast("int")).alias("date"),
        F.lit("n").alias("name"), F.concat(F.lit("s"), F.col("id") % 2).alias("sector"), *[c.alias(n) for n, c in numbers.items()], *[(F.col("id") % 13).cast("double").alias(t) for t in boosting.TARGETS],
    )
    monkeypatch.setattr("quantloom.bindings.learning._samples", lambda spark, d: samples)
    REGISTRY[query].run(spark, "")
    assert asked == [(2000, 25)] * n_models


def test_no_rows_or_no_features(spark):
    empty = spark.createDataFrame([], "id long, a double, b double, y double")
    blocks = trees.pack(empty, ["a", "b"], BORDERS, F.xxhash64("id"), F.col("y"), [F.lit(trees.TRAINING)])
    model, = trees.boost(blocks, BORDERS, 1, iterations=2, depth=3, rate=0.15)
    assert model.predict(model.bins(np.zeros((2, 2)))).tolist() == [0.0, 0.0]
    with pytest.raises(ValueError, match="a feature"):
        trees.boost(blocks, [], 1, iterations=1, depth=3, rate=0.15)


def test_training_reads_its_input_once(spark):
    """Four models of a horizon share one written table: the input is not computed again for each pass."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return float(v % 13)

    base = spark.range(600).select(
        F.concat(F.lit("T"), F.col("id") % 20).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / 20).cast("int")).alias("date"),
        F.lit("n").alias("name"), F.concat(F.lit("c"), F.col("id") % 3).alias("code"), counted("id").alias("margin"),
        *[(F.col("id") % 13).cast("double").alias(t) for t in boosting.TARGETS],
    )
    model = boosting.train_horizon(base, boosting.TARGETS[1], seed=1, iterations=2)
    assert model.best_iteration >= 1
    assert seen.value == 600


def test_rows_with_equal_keys_are_explained_apart(spark):
    """Contributions of two rows of one key are not added up, and no row is lost or doubled."""
    base = spark.range(400).select(
        F.concat(F.lit("T"), F.col("id") % 20).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / 40).cast("int")).alias("date"),
        F.lit("n").alias("name"), (F.col("id") % 13).cast("double").alias("margin"), *[(F.col("id") % 13).cast("double").alias(t) for t in boosting.TARGETS],
    )
    model = boosting.train_horizon(base, boosting.TARGETS[1], seed=1, iterations=2)
    assert boosting.attributions(base, model).count() == 400
    assert boosting.prediction_long(base, model).count() == 400
