"""One model per horizon that learns mean and uncertainty together; see ``symmetric``.

Categories are numbers by ordered target statistics: a training row takes the
mean target of the rows of its category that come before it in a hashed order,
so its own target is no part of it; every other row takes the mean of all
training rows.  Models have the columns of ``boosting`` and go through the same
functions (``score``, ``attributions``, ``prediction_long`` and what uses
them); their attributions are exact.  They can be stored and loaded again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.functions.scalars import hash_unit
from quantloom.models import boosting, symmetric
from quantloom.operators.filters import drop_null_target, normalise_types
from quantloom.operators.setops import union_all
from quantloom.operators.skew import MAX_GROUP_ROWS, find_hot_keys, join_on_keys, split_hot, with_slices
from quantloom.session import stored

#: Rows that a category's mean borrows from the overall mean.
PRIOR_ROWS = 1.0


def _mean(total: Column, number: Column, prior: float, weight: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + weight * prior) / (F.coalesce(number, F.lit(0)) + weight)


def ordered_target_mean(
    df: DataFrame, category: str, target: str, identity: Sequence[str], seed: int, prior: float, name: str,
    weight: float = PRIOR_ROWS, max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds the smoothed mean target of the rows of a category that come earlier in a hashed order.

    The order is that of a hash of ``identity``, which names a row.  Categories
    of more than ``max_group_rows`` rows are cut into slices along it, and each
    slice starts from the sums of those before.  A null category is one of its
    own; rows without a target count for nothing.
    """
    order = ["_place", *identity]
    placed = df.withColumn("_place", hash_unit(*identity, seed=seed))

    def sums(rows: DataFrame, *keys: str) -> DataFrame:
        earlier = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return rows.withColumns({"_total": F.coalesce(F.sum(target).over(earlier), F.lit(0.0)), "_number": F.count(target).over(earlier)})

    hot = find_hot_keys(placed, [category], max_group_rows) if max_group_rows else None
    if hot is None:
        out = sums(placed, category)
    else:
        rest, large = split_hot(placed, hot)
        sliced = with_slices(large, hot, order)
        before = W.partitionBy(category).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
        parts = sliced.groupBy(category, "_slice").agg(F.sum(target).alias("_t"), F.count(target).alias("_n"))
        starts = parts.select(category, "_slice", F.sum("_t").over(before).alias("_first_total"), F.sum("_n").over(before).alias("_first_number"))
        joined = join_on_keys(sums(sliced, category, "_slice"), starts, [category, "_slice"], hot.small)
        shifted = joined.withColumns({
            "_total": F.col("_total") + F.coalesce("_first_total", F.lit(0.0)), "_number": F.col("_number") + F.coalesce("_first_number", F.lit(0)),
        })
        out = union_all([sums(rest, category), shifted.select(*placed.columns, "_total", "_number")])
    return out.withColumn(name, _mean(F.col("_total"), F.col("_number"), prior, weight)).drop("_place", "_total", "_number")


def category_totals(train: DataFrame, categorical: Sequence[str], target: str) -> DataFrame:
    """(feature, category, total, number) of all training rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_c_{c}").alias("category")) for c in categorical])
    long = train.select(F.inline(pairs), F.col(target).alias("_y"))
    return long.groupBy("feature", "category").agg(F.sum("_y").alias("total"), F.count("_y").alias("number"))


@dataclass
class UncertaintyModel:
    target: str
    seed: int
    features: list[str]
    categorical: list[str]
    categories: DataFrame | None
    prior: float
    ensemble: symmetric.Ensemble
    trained_at: datetime = field(default_factory=datetime.now)

    @property
    def best_iteration(self) -> int:
        return self.ensemble.best_iteration

    def encoded(self, df: DataFrame) -> DataFrame:
        """Rows with a number ``_f_<feature>`` per feature, categories by the means of all training rows."""
        out = _numeric(normalise_types(df), self.features, self.categorical)
        for c in self.categorical:
            own = self.categories.where(F.col("feature") == c).select(F.col("category").alias(f"_c_{c}"), "total", "number")
            out = out.join(own, f"_c_{c}", "left").withColumn(f"_f_{c}", _mean(F.col("total"), F.col("number"), self.prior, PRIOR_ROWS)).drop("total", "number")
        return out

    def predicted(self, df: DataFrame, keep: Sequence[str], extra: Mapping[str, Column] | None = None, permutations: int = 0) -> DataFrame:
        """``keep``, ``extra`` columns and what ``symmetric.predict`` adds; contributions are exact, so ``permutations`` has no use."""
        return symmetric.predict(self.encoded(df).withColumns(dict(extra or {})), self.ensemble, [*keep, *(extra or {})])

    def score(self, df: DataFrame, keep: Sequence[str], std_formula: str) -> DataFrame:
        return boosting.score(df, self, keep, std_formula)

    def attributions(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return boosting.attributions(df, self, keep)

    def importances(self, df: DataFrame) -> list[float]:
        """Mean absolute contributions over the rows of ``df``, as shares of one."""
        means = self.attributions(df, []).agg(*[F.avg(F.abs(f"shap_{c}")) for c in self.features]).first()
        whole = sum(m or 0.0 for m in means)
        return [(m or 0.0) / whole if whole else 0.0 for m in means]


def _numeric(df: DataFrame, features: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return df.withColumns({
        (f"_c_{c}" if c in categorical else f"_f_{c}"): F.coalesce(F.col(c).cast("string"), F.lit("None")) if c in categorical else F.col(c).cast("double")
        for c in features
    })


def train_uncertainty(
    df: DataFrame, target: str, seed: int = 0, iterations: int = boosting.ITERATIONS["dev"],
    identity: Sequence[str] = boosting.IDENTITY, labels: Sequence[str] = boosting.LABEL_COLUMNS, **options,
) -> UncertaintyModel:
    """Fits mean and deviation in one ensemble, cut at the best validation round; ``options`` go to ``symmetric.fit``."""
    rows = boosting.split(boosting.training_frame(normalise_types(df), target, labels), seed, identity=identity)
    features = boosting.feature_names(rows, target, labels, identity)
    kinds = dict(rows.dtypes)
    categorical = [c for c in features if kinds[c] not in ("double", "float")]
    # All rows are written, since a filter by the hash would take every hash twice.
    numeric = stored(_numeric(rows, features, categorical), "training").where("split <> 'test'")
    train = numeric.where("split = 'train'")
    prior = float(train.agg(F.avg(target)).first()[0] or 0.0)
    categories = stored(category_totals(train, categorical, target), "categories") if categorical else None
    blank = symmetric.Ensemble([f"_f_{c}" for c in features], [], (0.0, 0.0))
    model = UncertaintyModel(target, seed, features, categorical, categories, prior, blank)
    ordered = train
    for c in categorical:
        ordered = ordered_target_mean(ordered, f"_c_{c}", target, identity, seed + 2, prior, f"_f_{c}")
    columns = [target, "split", *blank.features]
    encoded = union_all([ordered.select(*columns), model.encoded(numeric.where("split = 'validation'")).select(*columns)])
    options = {"depth": boosting.DEPTH, "rate": boosting.LEARNING_RATE, "min_rows": boosting.sampling(target)["minInstancesPerNode"]} | options
    model.ensemble = symmetric.fit(stored(encoded, "training"), target, blank.features, F.col("split") == "validation", iterations, **options)
    return model


def save_model(model: UncertaintyModel, spark: SparkSession, path: str) -> None:
    """Writes the trees, the category table and the description below a new folder."""
    symmetric.save(model.ensemble, spark, f"{path}/trees")
    facts = {k: getattr(model, k) for k in ("target", "seed", "features", "categorical", "prior")} | {"trained_at": model.trained_at.isoformat()}
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.text(f"{path}/facts")
    if model.categories is not None:
        model.categories.write.parquet(f"{path}/categories")


def load_model(spark: SparkSession, path: str) -> UncertaintyModel:
    facts = json.loads(spark.read.text(f"{path}/facts", wholetext=True).first()[0])
    facts["trained_at"] = datetime.fromisoformat(facts["trained_at"])
    categories = spark.read.parquet(f"{path}/categories") if facts["categorical"] else None
    return UncertaintyModel(**facts, categories=categories, ensemble=symmetric.load(spark, f"{path}/trees"))


def training_statistics(df: DataFrame, model: UncertaintyModel, identity: Sequence[str] = boosting.IDENTITY) -> DataFrame:
    """One row for the history of models: part sizes, and RMSE, MAPE and R² of the held-out rows.

    MAPE is on the scale of returns and leaves out rows that end at nothing.
    """
    rows = boosting.split(drop_null_target(normalise_types(df), model.target), model.seed, identity=identity)
    scored = model.score(rows, [*identity, "split"], "delta")
    actual, error = F.col("actual_value_log"), F.col("actual_value_log") - F.col("predicted_value_log")
    relative = F.abs((F.col("actual_value") - F.col("predicted_value")) / F.when(F.col("actual_value") != 0, F.col("actual_value")))
    test = F.col("split") == "test"
    of = lambda c: F.when(test, c)
    return scored.agg(
        F.lit(model.target).alias("pred_col"), F.lit(model.seed).alias("model_seed"), F.lit(model.best_iteration).alias("best_iteration"),
        F.lit(model.trained_at).cast("timestamp_ntz").alias("trained_at"), F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("split") == p).alias(f"n_{p}") for p in ("train", "validation", "test")],
        F.sqrt(F.avg(of(error * error))).alias("test_rmse"), F.avg(of(relative)).alias("test_mape"),
        (1 - F.sum(of(error * error)) / F.nullif(F.var_pop(of(actual)) * F.count_if(test), F.lit(0.0))).alias("test_r2"),
    )


def column_statistics(df: DataFrame, model: UncertaintyModel) -> DataFrame:
    """(pred_col, feature, n, missing, mean, deviation, low, high) of the numbers that the model reads, from one pass."""
    rows = drop_null_target(normalise_types(df), model.target)
    numbers = [c for c in model.features if c not in model.categorical]
    if not numbers:
        return rows.sparkSession.createDataFrame([], "pred_col string, feature string, n long, missing long, mean double, deviation double, low double, high double")
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    facts = [F.struct(
        F.lit(model.target).alias("pred_col"), F.lit(c).alias("feature"), F.count(v).alias("n"), F.count_if(v.isNull()).alias("missing"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("deviation"), F.min(v).alias("low"), F.max(v).alias("high"),
    ) for c, v in known.items()]
    return rows.agg(F.array(*facts).alias("_facts")).select(F.inline("_facts"))
