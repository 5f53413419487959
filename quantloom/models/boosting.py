"""One boosted regressor per horizon, with uncertainty and per-feature attributions.

Training, scoring and attribution are Spark jobs; the driver holds the trees
and a few numbers per feature.  Training rows are written once and the models
of a horizon grow in the same passes over them (see ``trees``).  Category means
are a table of their own, grouped and joined by Spark, whatever the number of
categories.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions.scalars import back_transform, hash_unit, predicted_std
from quantloom.models import trees
from quantloom.operators.filters import drop_null_target, normalise_types, require_rows, since
from quantloom.operators.reshape import rmse, unpivot_features
from quantloom.operators.setops import other_columns, union_all
from quantloom.operators.windows import latest_per_key
from quantloom.schemas import PREDICTIONS_DDL, PREDICTIONS_KEY
from quantloom.session import checkpointed, stored
from quantloom.sources.csv import cast_to
from quantloom.sources.tables import upsert_partitions

# What a model must not see, and how it is trained.
TARGETS = (
    "excess_return_ln_6m", "excess_return_ln_12m", "excess_return_ln_24m", "excess_return_ln_36m",
)
TRAINED_TARGETS = TARGETS[1:]
LABEL_COLUMNS = ("name", *TARGETS)
IDENTITY = ("ticker", "date")
TEST_SIZE, VALIDATION_SIZE = 0.03, 0.05
DEPTH, LEARNING_RATE = 6, 0.15
ITERATIONS = {"prod": 2000, "dev": 200, "test": 1}
PATIENCE = 25
# Below every real value, as trees order missing numbers first.
MISSING = -1e30
# Rows that a category's mean borrows from the overall mean.
SMOOTHING = 10.0
# Parts of the training rows whose own targets stay out of their category means; steps of a mean in a deviation.
FOLDS = 5
CATEGORY_STEPS = 20
# Mean of log(z^2) for a standard normal z, with the sign turned.
LOG_CHI2_SHIFT = 1.2703628454614782


def sampling(target: str) -> dict[str, float]:
    """The shortest horizon overfits and is held back more."""
    if target == "excess_return_ln_6m":
        return {"subsamplingRate": 0.8, "minInstancesPerNode": 15}
    return {"subsamplingRate": 0.9, "minInstancesPerNode": 10}


def split(
    df: DataFrame, seed: int, test: float = TEST_SIZE, validation: float = VALIDATION_SIZE,
    identity: Sequence[str] = IDENTITY, name: str = "split",
) -> DataFrame:
    """Marks rows ``test``, ``validation`` or ``train`` by a hash of their identity.

    A row keeps its part whatever the partitioning, so reruns after an executor
    loss cannot leak test rows into training.
    """
    holdout = hash_unit(*identity, seed=seed) < test
    checked = hash_unit(*identity, seed=seed + 1) < validation
    return df.withColumn(
        name, F.when(holdout, "test").when(checked, "validation").otherwise("train"),
    )


def training_frame(df: DataFrame, target: str, labels: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Rows with a target, without the name and the other horizons."""
    kept = df.select(other_columns(df, set(labels) - {target}))
    return drop_null_target(kept, target)


def feature_names(
    df: DataFrame, target: str, labels: Sequence[str] = LABEL_COLUMNS,
    identity: Sequence[str] = IDENTITY,
) -> list[str]:
    return other_columns(df, {*labels, *identity, target, "split"})


@dataclass
class HorizonModel:
    target: str
    seed: int
    features: list[str]
    categorical: list[str]
    categories: DataFrame | None
    prior: float
    step: float
    mean: trees.Boosted
    variance: trees.Boosted
    baseline: list[float]
    trained_at: datetime = field(default_factory=datetime.now)

    @property
    def best_iteration(self) -> int:
        return len(self.mean.trees)

    def predicted(
        self, df: DataFrame, keep: Sequence[str], extra: Mapping[str, Column] | None = None, permutations: int = 0,
    ) -> DataFrame:
        """``keep``, ``extra`` columns, prediction and variance; with ``permutations`` also contributions and bias."""
        return _predicted(_encoded(df, self).withColumns(dict(extra or {})), self, [*keep, *(extra or {})], permutations)


def _numeric(df: DataFrame, features: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numbers as double with a sentinel for missing, categories as text."""
    columns = {}
    for c in features:
        if c in categorical:
            columns[f"_c_{c}"] = F.coalesce(F.col(c).cast("string"), F.lit("None"))
        else:
            v = F.col(c).cast("double")
            columns[f"_f_{c}"] = F.when(v.isNull() | F.isnan(v), MISSING).otherwise(v)
    return df.withColumns(columns)


def _category_sums(train: DataFrame, categorical: Sequence[str], target: str) -> DataFrame:
    """(feature, category, sum and number of targets, and both by fold) of the training rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_c_{c}").alias("category")) for c in categorical])
    long = train.select(F.inline(pairs.cast("array<struct<feature:string,category:string>>")), "_fold", F.col(target).alias("_y"))
    by_fold = long.groupBy("feature", "category", "_fold").agg(F.sum("_y").alias("s"), F.count("_y").alias("n"))
    entry = F.struct("_fold", F.struct("s", "n"))
    return by_fold.groupBy("feature", "category").agg(
        F.sum("s").alias("total"), F.sum("n").alias("number"), F.map_from_entries(F.collect_list(entry)).alias("folds"),
    )


def _encode(
    df: DataFrame, categories: DataFrame | None, prior: float, step: float, categorical: Sequence[str],
) -> DataFrame:
    """Each category as its smoothed mean target, in steps.

    A training row (with a ``_fold``) takes the mean of the other folds, so its
    own target is no part of it; all other rows take the mean of all.  The steps
    are so wide that the folds of a large category agree; else trees would tell
    folds apart, which says nothing about new rows.
    """
    out = df
    for c in categorical:
        own = categories.where(F.col("feature") == c).select(F.col("category").alias(f"_c_{c}"), "total", "number", "folds")
        joined = out.join(own, f"_c_{c}", "left")
        fold = F.col("folds")[F.col("_fold")]
        total = F.coalesce("total", F.lit(0.0)) - F.coalesce(fold["s"], F.lit(0.0))
        number = F.coalesce("number", F.lit(0)) - F.coalesce(fold["n"], F.lit(0))
        value = (total + SMOOTHING * prior) / (number + SMOOTHING)
        out = joined.withColumn(f"_f_{c}", F.rint(value / step) * step).drop("total", "number", "folds")
    return out


def train_horizon(
    df: DataFrame, target: str, seed: int = 0, iterations: int = ITERATIONS["dev"],
    identity: Sequence[str] = IDENTITY, labels: Sequence[str] = LABEL_COLUMNS, patience: int = 0,
) -> HorizonModel:
    """Fits the mean, then the log variance of residuals that the mean did not see.

    Boosting stops when the validation error no longer falls, or has not fallen
    for ``patience`` trees, and keeps the trees up to its smallest.  For the variance
    either half of the training rows is predicted by a model of the other half;
    both grow together with the mean.
    """
    rows = split(training_frame(normalise_types(df), target, labels), seed, identity=identity)
    features = feature_names(rows, target, labels, identity)
    kinds = dict(rows.dtypes)
    categorical = [c for c in features if kinds[c] not in ("double", "float")]
    place, fold = F.xxhash64(*identity), F.pmod(F.xxhash64(*identity, F.lit(seed + 2)), F.lit(FOLDS)).cast("int")
    numbers = [f"_c_{c}" if c in categorical else f"_f_{c}" for c in features]
    # All rows are written, since a filter by the hash would take every hash twice.
    whole = stored(_numeric(rows, features, categorical).select(
        F.col(target).cast("double").alias(target), "split", place.alias("_place"), fold.alias("_hash"), *numbers,
    ), "training")
    usable = whole.where("split <> 'test'").select(
        target, (F.col("split") == "validation").alias("_validation"), F.when(F.col("split") == "train", F.col("_hash")).alias("_fold"), "_place", *numbers,
    )
    train = usable.where("not _validation")
    categories = stored(_category_sums(train, categorical, target), "categories") if categorical else None
    center = train.agg(F.avg(target), F.stddev_samp(target)).first()
    prior, step = float(center[0] or 0.0), float(center[1] or 0.0) / CATEGORY_STEPS or 1.0
    encoded = _encode(usable, categories, prior, step, categorical)
    values = [f"_f_{c}" for c in features]
    borders = trees.quantile_borders(encoded.where("not _validation"), values, MISSING)
    half = F.col("_fold") % 2
    roles = [F.when(F.col("_validation"), trees.VALIDATION).when(own, trees.TRAINING).otherwise(trees.UNUSED) for own in (F.lit(True), half != 0, half != 1)]
    blocks = trees.pack(encoded, values, borders, F.col("_place"), F.col(target), roles)
    sampled = sampling(target)
    options = {"iterations": iterations, "depth": DEPTH, "rate": LEARNING_RATE, "share": sampled["subsamplingRate"], "min_rows": sampled["minInstancesPerNode"], "seed": seed, "patience": patience}
    mean, *halves = trees.boost(blocks, borders, len(roles), **options)
    variance, = trees.boost(trees.unseen_residuals(blocks, mean, halves), borders, 1, **options)
    means = encoded.agg(*[F.avg(F.when(F.col(v) != MISSING, F.col(v))).alias(v) for v in values]).first() if values else []
    baseline = [MISSING if m is None else float(m) for m in means]
    return HorizonModel(target, seed, features, categorical, categories, prior, step, mean, variance, baseline)


def _encoded(df: DataFrame, model: HorizonModel) -> DataFrame:
    """Rows with a number ``_f_<feature>`` per feature, categories by the means of all training rows."""
    numeric = _numeric(normalise_types(df), model.features, model.categorical)
    return _encode(numeric.withColumn("_fold", F.lit(None).cast("int")), model.categories, model.prior, model.step, model.categorical)


def _predicted(df: DataFrame, model: HorizonModel, keep: Sequence[str], permutations: int) -> DataFrame:
    """Evaluates both models on the rows of ``_encoded``; contributions are weighted sums over feature subsets."""
    width, mean, variance = len(model.features), model.mean, model.variance
    subsets, weights = _coalitions(width, permutations, model.seed) if permutations else ([], [])
    masks, shares = np.array(subsets, bool).reshape(-1, width), np.array(weights).reshape(-1, width)
    absent = mean.bins(np.array([model.baseline]).reshape(1, width))
    added = "prediction double, variance double" + ", contributions array<double>, bias double" * bool(permutations)
    names = [c.split()[0] for c in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias = float(mean.predict(absent)[0])
        for batch in batches:
            n = batch.num_rows
            bins = mean.bins(trees.matrix(batch.column("_x"), width))
            new = [pa.array(mean.predict(bins)), pa.array(np.exp(variance.predict(bins) + LOG_CHI2_SHIFT))]
            if permutations:
                total = np.zeros((n, width))
                for mask, share in zip(masks, shares):
                    total += share * mean.predict(np.where(mask[:, None], bins, absent))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(total.ravel()))
                new += [lists, pa.array(np.full(n, bias))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *new], [*batch.schema.names[: len(keep)], *names])

    picked = df.select(*keep, F.array(*[F.col(f"_f_{c}").cast("double") for c in model.features]).alias("_x"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keep)])
    return picked.mapInArrow(run, f"{fields}, {added}" if fields else added)


def score(
    df: DataFrame, model: HorizonModel, keep: Sequence[str] = IDENTITY,
    std_formula: str = "delta",
) -> DataFrame:
    """Mean and variance on the log scale, and back on the return scale."""
    return _scores(model.predicted(df, list(dict.fromkeys([*keep, model.target]))), model, keep, std_formula)


def _scores(predicted: DataFrame, model: HorizonModel, keep: Sequence[str], std_formula: str) -> DataFrame:
    return predicted.select(
        *keep, F.col(model.target).alias("actual_value_log"), F.col("prediction").alias("predicted_value_log"), "variance",
        back_transform("prediction").alias("predicted_value"),
        predicted_std("prediction", "variance", std_formula).alias("predicted_std"),
        back_transform(model.target).alias("actual_value"),
    )


def evaluate(df: DataFrame, model: HorizonModel, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Holdout error, iterations, seed and part sizes as one row."""
    rows = split(drop_null_target(df, model.target), model.seed, identity=identity)
    held_out = score(rows.where("split = 'test'"), model, identity)
    sizes = rows.groupBy().agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("split") == p).alias(f"n_{p}") for p in ("train", "validation", "test")],
    )
    return sizes.select(
        F.lit(model.target).alias("pred_col"), F.lit(model.seed).alias("model_seed"),
        F.lit(model.best_iteration).alias("best_iteration"),
        rmse(held_out, "actual_value_log", "predicted_value_log").scalar().alias("test_rmse"),
        "n_rows", "n_train", "n_validation", "n_test",
    )


def _coalitions(n: int, permutations: int, seed: int) -> tuple[list[tuple[bool, ...]], list[list[float]]]:
    """Feature subsets to evaluate, and each one's weight in every feature's attribution."""
    if n <= 4:
        orders = list(itertools.permutations(range(n)))
    else:
        draw = random.Random(seed)
        orders = []
        while len(orders) < max(1, permutations // 2):
            order = draw.sample(range(n), n)
            orders += [tuple(order), tuple(reversed(order))]
    weights: dict[tuple[bool, ...], list[float]] = {}
    for order in orders:
        inside = [False] * n
        before = tuple(inside)
        for f in order:
            inside[f] = True
            after = tuple(inside)
            weights.setdefault(before, [0.0] * n)[f] -= 1 / len(orders)
            weights.setdefault(after, [0.0] * n)[f] += 1 / len(orders)
            before = after
    return list(weights), list(weights.values())


def attributions(
    df: DataFrame, model: HorizonModel, keep: Sequence[str] = IDENTITY, permutations: int = 8,
) -> DataFrame:
    """Shapley contributions ``shap_<feature>`` and ``bias``; they add up to the prediction.

    A feature that is absent takes its mean.  Each row is evaluated on a fixed
    set of feature subsets; a contribution is a weighted sum of those
    predictions.  Models with exact contributions of their own give those.
    """
    return model.predicted(df, keep, permutations=permutations).select(*keep, *_shares(model), "bias")


def _shares(model: HorizonModel) -> list[Column]:
    return [F.get("contributions", F.lit(k)).alias(f"shap_{c}") for k, c in enumerate(model.features)]


def prediction_long(
    df: DataFrame, model: HorizonModel, keep: Sequence[str] = IDENTITY, permutations: int = 8,
    std_formula: str = "stored",
) -> DataFrame:
    """One row per input row and feature, in the layout of the predictions table."""
    texts = {f"value_{c}": F.col(c).cast("string") for c in model.features}
    predicted = model.predicted(df, list(dict.fromkeys([*keep, model.target])), texts, permutations)
    kept = [*keep, *texts, *_shares(model), "bias"]
    rows = unpivot_features(
        _scores(predicted, model, kept, std_formula),
        [*keep, "bias", "predicted_value_log", "actual_value_log", "predicted_value", "predicted_std", "actual_value"],
        {
            c: {"shap_value": F.col(f"shap_{c}"), "feature_value": F.col(f"value_{c}")}
            for c in model.features
        },
    )
    stamp = F.lit(model.trained_at).cast("timestamp_ntz")
    return rows.select(
        "date", "ticker", "feature", "shap_value", "feature_value", "bias", "predicted_value_log",
        "actual_value_log", "predicted_value", "predicted_std", "actual_value",
        F.lit(model.target).alias("pred_col"), stamp.alias("trained_at"),
        stamp.cast("date").alias("trained_date"),
    )


def latest_predictions(df: DataFrame, model: HorizonModel, start: str | None = None, **options) -> DataFrame:
    """Long predictions of each key's latest row, or of all rows since a day."""
    if start is None:
        rows = latest_per_key(df, "ticker", "date")
    else:
        rows = require_rows(since(df, "date", start), f"no rows from {start} on")
    return prediction_long(rows, model, **options)


def explain_key(
    df: DataFrame, model: HorizonModel, key: str, start: str | None = None, **options,
) -> DataFrame:
    """Long predictions of one key, its latest row or all since a day."""
    rows = require_rows(df.where(F.col("ticker") == key.upper()), f"{key} not found in dataset")
    options.setdefault("std_formula", "delta")
    return latest_predictions(rows, model, start, **options)


def key_history(df: DataFrame, model: HorizonModel, key: str, start: str = "2019-01-01") -> DataFrame:
    """Predicted and actual returns of one key after a day, newest first."""
    rows = since(df.where(F.col("ticker") == key.upper()), "date", start, inclusive=False)
    return score(rows, model).select(
        F.col("predicted_value").alias("predicted_excess_return"), "predicted_std", "ticker",
        "date", F.col("actual_value").alias("actual_excess_return"),
    ).orderBy(F.col("date").desc())


def feature_importance(model: HorizonModel, df: DataFrame) -> DataFrame:
    """Features by importance, largest first (one row per feature)."""
    shares = model.mean.featureImportances.toArray() if isinstance(model, HorizonModel) else model.importances(df)
    values = [(n, float(v)) for n, v in zip(model.features, shares)]
    table = df.sparkSession.createDataFrame(values, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def train_all(
    df: DataFrame, targets: Sequence[str] = TRAINED_TARGETS, seed: int = 0,
    iterations: int = ITERATIONS["dev"], train: Callable[..., HorizonModel] | None = None,
) -> dict[str, HorizonModel]:
    """One model per horizon from one materialised feature table; ``train`` may be ``uncertainty.train_uncertainty``."""
    stored = checkpointed(df)
    return {t: (train or train_horizon)(stored, t, seed, iterations) for t in targets}


def each_horizon(train: Callable[[str], HorizonModel], targets: Sequence[str] = TRAINED_TARGETS) -> dict[str, HorizonModel]:
    """A model per horizon, trained side by side."""
    with ThreadPoolExecutor(max(1, len(targets))) as pool:
        return dict(zip(targets, pool.map(train, targets)))


def all_predictions(df: DataFrame, models: Mapping[str, HorizonModel], **options) -> DataFrame:
    return union_all([latest_predictions(df, m, **options) for m in models.values()])


def create_predictions(spark: SparkSession, path: str) -> None:
    """An empty table of predictions, partitioned by the day of training."""
    layout = spark.createDataFrame([], PREDICTIONS_DDL).drop("trained_date")
    layout.coalesce(1).write.parquet(f"{path}/trained_date=1970-01-01")


def publish_predictions(rows: DataFrame, path: str) -> None:
    """Upserts long predictions into the table, in its own types."""
    typed = cast_to(rows, PREDICTIONS_DDL)
    upsert_partitions(rows.sparkSession, path, typed, PREDICTIONS_KEY, "trained_date")


def train_and_publish(
    df: DataFrame, path: str, targets: Sequence[str] = TRAINED_TARGETS, seed: int = 0,
    iterations: int = ITERATIONS["dev"], **options,
) -> dict[str, HorizonModel]:
    """The training job: a model per horizon, the latest predictions of all into the table."""
    models = train_all(df, targets, seed, iterations)
    publish_predictions(all_predictions(df, models, **options), path)
    return models
