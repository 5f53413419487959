"""Bound queries: splitting, training, scoring and explaining.

Boosted trees have no SQL counterpart, so SQL checks what must hold for any
model: part sizes, one score per row, contributions that add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quantloom.bindings.registry import bind, table
from quantloom.models import boosting, symmetric, uncertainty
from quantloom.operators.filters import latest_only
from quantloom.session import scratch_path, stored

TARGET = "excess_return_ln_12m"
# Queries that need some model take a small one; those whose job is the training train as in production.
ITERATIONS = 6
WHOLE = (boosting.ITERATIONS["prod"], boosting.PATIENCE)
SEED = 3
_UNIT = "('0x' || substr(md5(concat_ws('|', ticker, cast(date as varchar), '{}')), 1, 7))::bigint / 268435456.0"
_SPLIT = f"""parts as (
    select ticker, date, case when {_UNIT.format(SEED)} < 0.03 then 'test'
      when {_UNIT.format(SEED + 1)} < 0.05 then 'validation' else 'train' end as split
    from samples)"""

_MODELS: dict[tuple, boosting.HorizonModel] = {}
_SAMPLES: dict[tuple, DataFrame] = {}


def _samples(spark, d):
    """The table of samples, written once per session and input: training and every model read it again."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SAMPLES:
        _SAMPLES[key] = stored(table(spark, d, "samples"), "samples")
    return _SAMPLES[key]


def _model(spark, d, target=TARGET, iterations=ITERATIONS, patience=0):
    """Trained once per session and input."""
    key = (spark.sparkContext.applicationId, d, target, iterations, patience)
    if key not in _MODELS:
        _MODELS[key] = boosting.train_horizon(_samples(spark, d), target, SEED, iterations, patience=patience)
    return _MODELS[key]


@bind("train_split", "I1", f"with {_SPLIT} select * from parts")
def _(spark, d):
    return boosting.split(table(spark, d, "samples").select("ticker", "date"), SEED)


@bind("training_frame", "I2 B14 B15 G3", f"""
    select ticker, date, sector, quantity, money, discount, tax, round({TARGET}, 6) as {TARGET}
    from samples where {TARGET} is not null""")
def _(spark, d):
    out = boosting.training_frame(table(spark, d, "samples"), TARGET)
    return out.withColumn(TARGET, F.round(TARGET, 6))


@bind("train_and_evaluate", "I3 I5 D12", f"""
    with {_SPLIT} select '{TARGET}' as pred_col, {SEED} as model_seed, count(*) as n_rows,
      count(*) filter (split = 'train') as n_train,
      count(*) filter (split = 'validation') as n_validation,
      count(*) filter (split = 'test') as n_test, true as beats_the_mean, true as boosted
    from parts""")
def _(spark, d):
    rows = _samples(spark, d)
    out = boosting.evaluate(rows, _model(spark, d, TARGET, *WHOLE))
    spread = rows.agg(F.stddev_samp(TARGET)).scalar()
    return out.withColumns({
        "beats_the_mean": F.col("test_rmse") < spread, "boosted": F.col("best_iteration") > 1,
    }).drop("test_rmse", "best_iteration")


@bind("score", "I6 H14")
def _(spark, d):
    return boosting.score(_samples(spark, d), _model(spark, d))


@bind("score_properties", "I6 H14", "select ticker, date, true as sound from samples")
def _(spark, d):
    out = boosting.score(_samples(spark, d), _model(spark, d))
    value = F.abs(F.col("predicted_value") - F.exp("predicted_value_log")) < 1e-9
    spread = (F.col("variance") > 0) & (F.col("predicted_std") > 0)
    return out.select("ticker", "date", (value & spread).alias("sound"))


@bind("attributions", "I7")
def _(spark, d):
    return boosting.attributions(_samples(spark, d), _model(spark, d), permutations=4)


@bind("attributions_add_up", "I7", "select ticker, date, true as adds_up from samples")
def _(spark, d):
    rows, model = _samples(spark, d), _model(spark, d)
    shares = boosting.attributions(rows, model, permutations=4)
    total = sum((F.col(f"shap_{f}") for f in model.features), F.col("bias"))
    scored = boosting.score(rows, model).select("ticker", "date", "predicted_value_log")
    return shares.join(scored, ["ticker", "date"]).select(
        "ticker", "date", (F.abs(total - F.col("predicted_value_log")) < 1e-9).alias("adds_up"),
    )


@bind("prediction_long", "I8 E10 H19", f"""
    with latest as (
      select * from samples qualify row_number() over (partition by ticker order by date desc) = 1)
    select ticker, date, feature, pred_col, round({TARGET}, 6) as actual_value_log
    from latest, (values ('sector'), ('quantity'), ('money'), ('discount'), ('tax')) f(feature),
      (select '{TARGET}' as pred_col)""")
def _(spark, d):
    out = boosting.latest_predictions(_samples(spark, d), _model(spark, d), permutations=4)
    return out.select(
        "ticker", "date", "feature", "pred_col", F.round("actual_value_log", 6).alias("actual_value_log"),
    )


_FEATURES = "(values ('sector'), ('quantity'), ('money'), ('discount'), ('tax')) f(feature)"


@bind("explain_key", "I9 B19 F3", f"""
    select ticker, date, feature, '{TARGET}' as pred_col, round({TARGET}, 6) as actual_value_log,
      true as adds_up
    from samples, {_FEATURES} where ticker = 'T3' and date >= date '2001-01-01'""")
def _(spark, d):
    out = boosting.explain_key(
        _samples(spark, d), _model(spark, d), "t3", start="2001-01-01", permutations=4,
    )
    total = F.sum("shap_value").over(W.partitionBy("ticker", "date")) + F.col("bias")
    return out.select(
        "ticker", "date", "feature", "pred_col", F.round("actual_value_log", 6).alias("actual_value_log"),
        (F.abs(total - F.col("predicted_value_log")) < 1e-9).alias("adds_up"),
    )


@bind("key_history", "I6 B19", f"""
    select ticker, date, round(exp({TARGET}), 5) as actual_excess_return, true as sound
    from samples where ticker = 'T3' and date > date '2000-01-01'""")
def _(spark, d):
    out = boosting.key_history(_samples(spark, d), _model(spark, d), "t3", "2000-01-01")
    sound = (F.col("predicted_std") > 0) & (F.col("predicted_excess_return") > 0)
    return out.select(
        "ticker", "date", F.round("actual_excess_return", 5).alias("actual_excess_return"),
        sound.alias("sound"),
    )


@bind("feature_importance", "I10 F6", f"select feature, true as sound from {_FEATURES}")
def _(spark, d):
    out = boosting.feature_importance(_model(spark, d), _samples(spark, d))
    return out.select("feature", F.col("importance").between(0, 1).alias("sound"))


@bind("train_all", "I4 I8 G1", f"""
    with latest as (
      select * from samples qualify row_number() over (partition by ticker order by date desc) = 1)
    select ticker, date, feature, pred_col, round(case pred_col
        when 'excess_return_ln_12m' then excess_return_ln_12m
        when 'excess_return_ln_24m' then excess_return_ln_24m else excess_return_ln_36m end, 6)
      as actual_value_log
    from latest, {_FEATURES},
      (values ('excess_return_ln_12m'), ('excess_return_ln_24m'), ('excess_return_ln_36m')) p(pred_col)""")
def _(spark, d):
    rows = _samples(spark, d)
    models = boosting.each_horizon(lambda t: _model(spark, d, t, *WHOLE))
    out = boosting.all_predictions(rows, models, permutations=4)
    return out.select(
        "ticker", "date", "feature", "pred_col", F.round("actual_value_log", 6).alias("actual_value_log"),
    )


@bind("training_job", "I8 K13", f"""
    with latest as (
      select * from samples qualify row_number() over (partition by ticker order by date desc) = 1)
    select ticker, date, feature, cast({TARGET} as float) as actual_value_log,
      cast(exp({TARGET}) as float) as actual_value, true as adds_up
    from latest, {_FEATURES}""")
def _(spark, d):
    """Published twice: the second run replaces the first one's rows."""
    path = scratch_path(spark, "predictions")
    boosting.create_predictions(spark, path)
    out = boosting.latest_predictions(_samples(spark, d), _model(spark, d), permutations=4)
    boosting.publish_predictions(out.withColumn("shap_value", F.lit(0.0)), path)
    boosting.publish_predictions(out, path)
    stored = latest_only(spark.read.parquet(path), "trained_date")
    total = F.sum("shap_value").over(W.partitionBy("ticker", "date", "pred_col")) + F.col("bias")
    return stored.select(
        "ticker", "date", "feature", "actual_value_log", "actual_value",
        (F.abs(total - F.col("predicted_value_log")) < 1e-5).alias("adds_up"),
    )


@bind("category_means", "I2", f"""
    with {_SPLIT}, train as (
      select sector, {TARGET} as y from samples join parts using (ticker, date) where split = 'train')
    select coalesce(sector, 'None') as category, count(*) as n, round(avg(y), 6) as mean_target from train group by 1""")
def _(spark, d):
    sums = _model(spark, d).categories.where("feature = 'sector'")
    return sums.select("category", F.col("number").alias("n"), F.round(F.col("total") / F.col("number"), 6).alias("mean_target"))


# ---- mean and uncertainty together ----------------------------------------------------------

_JOINT: dict[tuple, uncertainty.UncertaintyModel] = {}


def _joint(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _JOINT:
        _JOINT[key] = uncertainty.train_uncertainty(_samples(spark, d), TARGET, SEED, ITERATIONS, depth=3, n_borders=16)
    return _JOINT[key]


@bind("train_uncertainty", "I3 I5", f"""
    with {_SPLIT} select '{TARGET}' as pred_col, {SEED} as model_seed, count(*) as n_rows,
      count(*) filter (split = 'train') as n_train,
      count(*) filter (split = 'validation') as n_validation,
      count(*) filter (split = 'test') as n_test, true as beats_the_mean, true as boosted
    from parts""")
def _(spark, d):
    rows, model = _samples(spark, d), _joint(spark, d)
    spread = rows.agg(F.stddev_samp(TARGET)).scalar()
    out = boosting.evaluate(rows, model)
    return out.withColumns({
        "beats_the_mean": F.col("test_rmse") < spread, "boosted": F.col("best_iteration") > 1,
    }).drop("test_rmse", "best_iteration")


@bind("ordered_category_means", "I2", f"""
    select ticker, date, round((coalesce(sum({TARGET}) over w, 0) + (select avg({TARGET}) from samples))
      / (count({TARGET}) over w + 1), 6) as sector_mean
    from samples
    window w as (partition by sector order by {_UNIT.format(SEED)}, ticker, date rows between unbounded preceding and 1 preceding)""")
def _(spark, d):
    rows = table(spark, d, "samples").select("ticker", "date", "sector", TARGET)
    prior = rows.agg(F.avg(TARGET)).first()[0]
    # so low a limit that large sectors are cut into slices
    out = uncertainty.ordered_target_mean(rows, "sector", TARGET, ["ticker", "date"], SEED, prior, "sector_mean", max_group_rows=2000)
    return out.select("ticker", "date", F.round("sector_mean", 6).alias("sector_mean"))


@bind("model_history", "I5 I6", f"""
    select '{TARGET}' as pred_col, f.feature, count(x) as n, count(*) - count(x) as missing, round(avg(x), 6) as mean,
      min(x) as low, max(x) as high, true as loaded_alike
    from samples, {{features}}, lateral (select case f.feature when 'quantity' then quantity when 'money' then money
      when 'discount' then discount else tax end::double as x)
    where {TARGET} is not null group by f.feature""".replace("{features}", "(values ('quantity'), ('money'), ('discount'), ('tax')) f(feature)"))
def _(spark, d):
    """The statistics of a model's training columns, and its scores after it was stored and loaded."""
    rows, model = _samples(spark, d), _joint(spark, d)
    path = scratch_path(spark, "model")
    uncertainty.save_model(model, spark, path)
    both = [m.score(rows, ["ticker", "date"], "delta").select(F.sum("predicted_value_log"), F.sum("variance")).first() for m in (model, uncertainty.load_model(spark, path))]
    alike = all(abs(a - b) < 1e-6 * (1 + abs(a)) for a, b in zip(*both))
    facts = uncertainty.column_statistics(rows, model)
    return facts.select("pred_col", "feature", "n", "missing", F.round("mean", 6).alias("mean"), "low", "high", F.lit(alike).alias("loaded_alike"))


_CUTS = {"quantity": [10.0, 20.0, 30.0, 40.0], "discount": [0.025, 0.055, 0.085]}
_STUMP = """
    base as (select l_orderkey, l_linenumber, l_quantity::double as quantity, l_discount::double as discount,
      ln(l_extendedprice::double) as y, l_orderkey % {modulus} = {modulus} - 1 as held from lineitem),
    start as (select avg(y) as mu, stddev_pop(y) as sd from base where not held),
    gradients as (select base.*, y - mu as g, (y - mu) / sd as z, 0.5 * (((y - mu) / sd) ** 2 - 1) as v from base, start),
    cuts as (select * from (values ('quantity', 10.0), ('quantity', 20.0), ('quantity', 30.0), ('quantity', 40.0),
      ('discount', 0.025), ('discount', 0.055), ('discount', 0.085)) c(feature, cut)),
    sides as (select feature, cut, case feature when 'quantity' then quantity else discount end > cut as above,
      count(*) as n, sum(g) as g, sum(z) as z, sum(v) as v from gradients, cuts where not held group by 1, 2, 3),
    chosen as (select feature, cut from sides group by 1, 2 order by sum((z ** 2 + v ** 2) / n) desc limit 1),
    leaves as (select feature, cut, above, g / n as step, v / n as deviation from sides join chosen using (feature, cut))"""


def _stump(spark, d, modulus):
    """One tree of one split: small enough for SQL to find it as well."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("quantity"), F.col("l_discount").cast("double").alias("discount"),
        F.ln(F.col("l_extendedprice").cast("double")).alias("y"), (F.col("l_orderkey") % modulus == modulus - 1).alias("held"),
    )
    return rows, symmetric.fit(rows, "y", list(_CUTS), F.col("held"), 1, depth=1, rate=1.0, l2=0.0, min_rows=1, borders=list(_CUTS.values()))


@bind("exact_attributions", "I7 I9", f"""
    with {_STUMP.format(modulus=2_000_000_000)}
    select l_orderkey, l_linenumber, round(mu + step, 6) as prediction, round((sd * exp(deviation)) ** 2, 6) as variance,
      round(case feature when 'quantity' then step else 0 end, 6) as quantity,
      round(case feature when 'discount' then step else 0 end, 6) as discount,
      round(case feature when 'quantity' then deviation else 0 end, 6) as log_deviation_of_quantity, round(mu, 6) as bias
    from base, start, leaves where (case feature when 'quantity' then quantity else discount end > cut) = above""")
def _(spark, d):
    """Predictions, variances and contributions of every row; expected steps are 0, so the bias is the mean."""
    rows, model = _stump(spark, d, 2_000_000_000)
    out = symmetric.predict(rows, model, ["l_orderkey", "l_linenumber"])
    number = lambda c: F.round(c, 6) + F.lit(0.0)  # noqa: E731  (no negative zero)
    return out.select(
        "l_orderkey", "l_linenumber", number(F.col("prediction")).alias("prediction"), number(F.col("variance")).alias("variance"),
        number(F.col("contributions")[0]).alias("quantity"), number(F.col("contributions")[1]).alias("discount"),
        number(F.col("log_deviation_contributions")[0]).alias("log_deviation_of_quantity"), number(F.col("bias")).alias("bias"),
    )


@bind("validation_curve", "I3 I5", f"""
    with {_STUMP.format(modulus=4)},
    after as (select y, held, mu, sd, step, deviation from base, start, leaves
      where (case feature when 'quantity' then quantity else discount end > cut) = above),
    states as (select 0 as iteration, y - mu as e, ln(sd) as s from after where held
      union all select 1, y - mu - step, ln(sd) + deviation from after where held),
    curve as (select iteration, count(*) as rows, sqrt(avg(e ** 2)) as rmse,
      avg(0.5 * (e / exp(s)) ** 2 + s + 0.5 * ln(2 * pi())) as nll from states group by 1)
    select iteration, rows, round(rmse, 6) as rmse, round(nll, 6) as negative_log_likelihood, nll = min(nll) over () as is_best from curve""")
def _(spark, d):
    """Held-out errors before and after the tree, and the position of the minimum."""
    _, model = _stump(spark, d, 4)
    out = symmetric.curve_table(model, spark)
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "negative_log_likelihood")})
