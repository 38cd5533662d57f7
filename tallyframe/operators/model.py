"""Modelling operators (M1-M7): features, temporal split, fits, metrics, classes, model choice, scenarios.

Linear models come from one Gram aggregate (``linear``); forests and boosted trees from Spark ML.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut_lineage
from . import linear
from .rank import top1, with_history


def build_features(results: DataFrame, indicators: DataFrame, geo: str, time_col: str,
                   code_col: str, value_col: str, codes: Sequence[str]) -> DataFrame:
    """Results left-joined with indicators pivoted per code (explicit pivot values)."""
    wide = (indicators.groupBy(geo, time_col).pivot(code_col, list(codes))
            .agg(F.max(value_col)))
    return results.join(wide, [geo, time_col], "left")


def training_set(features: DataFrame, keys: Sequence[str], time_col: str, target: str, lags: int = 1,
                 bucket=None) -> DataFrame:
    """M1: features with the target's own history (lag 1..n and change) per key."""
    return with_history(features, keys, time_col, [target], n=lags, bucket=bucket)


def temporal_split(df: DataFrame, time_col: str, test_period) -> tuple[DataFrame, DataFrame]:
    """M2: train on periods before `test_period`, test on `test_period`."""
    return df.where(F.col(time_col) < test_period), df.where(F.col(time_col) == test_period)


def fit_regressors(train: DataFrame, features: Sequence[str], label: str, kinds=("linear", "forest", "gbt"),
                   seed: int = 7):
    """M3: fit Spark ML regressors on an assembled feature vector; returns {kind: model}."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    cast_train = cut_lineage(train.select(*[F.col(c).cast("double").alias(c) for c in features],
                              F.col(label).cast("double").alias(label)))  # imputer and fits read it
    # a series without a single value so far can't be imputed and says nothing
    filled = cast_train.agg(*[F.count(c) for c in features]).first()
    features = [c for c, n in zip(features, filled) if n]
    if not features:
        raise ValueError("no feature has a value in the training rows")
    imputed = [f"{f}__imp" for f in features]
    prep = [Imputer(inputCols=list(features), outputCols=imputed, strategy="median"),
            VectorAssembler(inputCols=imputed, outputCol="features", handleInvalid="keep")]
    estimators = {
        "linear": LinearRegression(featuresCol="features", labelCol=label),
        "forest": RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=20, seed=seed),
        "gbt": GBTRegressor(featuresCol="features", labelCol=label, maxIter=20, seed=seed),
    }
    return {k: Pipeline(stages=prep + [estimators[k]]).fit(cast_train) for k in kinds}


def regression_metrics(pred: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """M4: MAE, RMSE, R^2 in one decomposable pass (sst from sums, not a second scan)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    n = F.count(F.lit(1))
    sst = F.sum(y * y) - F.sum(y) * F.sum(y) / n
    return (pred.where(y.isNotNull() & p.isNotNull()).groupBy(*by)
            .agg(n.alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                 (F.lit(1.0) - F.sum(e * e) / sst).alias("r2")))


def class_accuracy(pred: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """M5: accuracy = correct / total over discretized targets."""
    return pred.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col(actual) == F.col(predicted)).alias("n_correct"))


def discretize(c: str, edges: Sequence[float], labels: Sequence[str]):
    """Score classes (low / medium / high ...) from fixed edges."""
    expr = None
    for i, edge in enumerate(edges):
        cond = F.col(c) < edge
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr.otherwise(F.lit(labels[len(edges)]))


def naive_lag_prediction(df: DataFrame, keys: Sequence[str], time_col: str, value: str) -> DataFrame:
    """Baseline predictor: the previous period's value for the same key."""
    return with_history(df, keys, time_col, [value]).withColumnRenamed(f"{value}_lag1", "prediction") \
        .drop(f"{value}_change")


def trend_projection(df: DataFrame, keys: Sequence[str], time_col: str, value: str,
                     horizons: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """M7: per-key linear trend (regr_slope/intercept, decomposable) projected at horizons."""
    t, y = F.col(time_col).cast("double"), F.col(value).cast("double")
    fit = df.groupBy(*keys).agg(F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"),
                                F.max(time_col).alias("last_period"))
    return (fit.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
            .withColumn("period", F.col("last_period") + F.col("horizon"))
            .withColumn("projection", F.col("intercept") + F.col("slope") * F.col("period").cast("double")))


def window_predictions(df: DataFrame, features: Sequence[str], label: str, time_col: str,
                       models: Mapping[str, Sequence[str]], fixed: Mapping[str, Mapping[str, float]] | None = None,
                       scale: int | None = None, least: int = 2) -> DataFrame:
    """M6: rows of each period that has `least` earlier ones, predicted by every linear model of the periods before.

    `models` names subsets of `features`, `fixed` models of given coefficients (persistence).  All windows of all
    models come from one Gram aggregate per period and its running sums: `df` is read once for them
    and once to be predicted.
    """
    columns = [*features, label]
    sums = linear.expanding(linear.gram(df.where(F.col(label).isNotNull()), columns, [time_col], scale), time_col, least=least)
    fitted = cut_lineage(linear.fit(sums, columns, [time_col], models))  # (period, model) rows
    for name, coef in (fixed or {}).items():
        fitted = fitted.unionByName(linear.fixed(fitted.where(F.col("model").isin(*models)), columns, name, coef, [time_col]))
    return linear.predict(df, fitted, columns, [time_col])


def compare_models(predictions: DataFrame, label: str, time_col: str) -> DataFrame:
    """M6: (model, period, n, mae, rmse, r2) of ``window_predictions``, one pass for all models and windows."""
    m = regression_metrics(predictions, label, "prediction", by=["model", time_col])
    return m.select("model", F.col(time_col).alias("period"), "n", "mae", "rmse", "r2")


def choose_model(metrics: DataFrame, interpretable: Sequence[str], tolerance: float = 0.05) -> DataFrame:
    """M6: the most stable and interpretable model, from (model, period, rmse) rows.

    A model's score is its mean RMSE over the windows plus the standard deviation of the RMSE (its instability).  Models
    within `tolerance` of the best score count as equally good; among these the first in `interpretable` (most
    interpretable first) is chosen, the others follow by score.  RMSEs are compared in thousandths.
    """
    order = {name: i for i, name in enumerate(interpretable)}
    place = F.coalesce(*[F.when(F.col("model") == name, F.lit(i)) for name, i in order.items()], F.lit(len(order)))

    def milli(c):
        return F.round(c * 1000).cast("bigint")

    scores = metrics.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_windows"), milli(F.avg("rmse")).alias("mean_rmse_milli"),
        milli(F.stddev_pop("rmse")).alias("spread_rmse_milli"), milli(F.max("rmse")).alias("worst_rmse_milli"))
    scores = scores.withColumn("score_milli", F.col("mean_rmse_milli") + F.col("spread_rmse_milli"))
    everything = Window.partitionBy(F.lit(1))  # one row per model
    near = F.col("score_milli") <= F.min("score_milli").over(everything) * (1.0 + tolerance)
    scores = scores.withColumn("interpretability", place).withColumn("near_best", near)
    ranked = everything.orderBy(F.col("near_best").desc(), F.when(F.col("near_best"), F.col("interpretability")),
                                "score_milli", "interpretability", "model")
    return scores.withColumn("rank", F.row_number().over(ranked)).withColumn("chosen", F.col("rank") == 1)


def winners(pred: DataFrame, keys: Sequence[str], option: str, actual: str, predicted: str) -> DataFrame:
    """M5: per group the option with the largest actual and with the largest predicted value (ties: smallest option)."""
    def first(value, name):
        return top1(pred, keys, [F.col(value).desc(), F.col(option).asc()]).select(*keys, F.col(option).alias(name))

    return first(actual, "actual").join(first(predicted, "predicted"), list(keys))


def confusion(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M5: (by, actual, predicted, n, n_actual, micro_recall) with the recall of each actual class in millionths."""
    counts = pairs.groupBy(*by, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(*by, "actual")
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).over(own)
    return counts.withColumn("n_actual", F.sum("n").over(own)).withColumn("__hit", hit) \
        .withColumn("micro_recall", S.micro_ratio("__hit", "n_actual")).drop("__hit")


def scenario_shares(start: DataFrame, indicators: DataFrame, model, features: Sequence[str], keys: Sequence[str], area: str,
                    share: str, time_col: str, code: str, value: str, horizons: int = 3, z: float = 1.2816,
                    low: float = 0.0, high: float = 1.0) -> DataFrame:
    """M7: recursive forecast of every `share`, `horizons` periods ahead, with a low, central and high band.

    `model` is one fitted row (``linear.fit``) whose first feature is the share one period before and whose others are
    indicator codes.  Each indicator's trend per area (a regression line; its mean where it has one value; the training
    mean where it has none) is put into the model, and each forecast is the lag of the next.  The bands are `z` standard errors: the
    residual variance, carried on by the lag's coefficient.  Shares are cut to [low, high] in the end.
    """
    codes, phi = list(features[1:]), float(model["coef"][0])
    weight = dict(zip(codes, (float(c) for c in model["coef"][1:])))
    mean = dict(zip(codes, (float(m) for m in model["mean"][1:])))
    constant = float(model["intercept"]) + sum(weight[c] * mean[c] for c in codes)
    variance = float(model["rss"]) / max(1, int(model["n"]) - int(model["n_coef"]) - 1)
    widths = [z * (variance * sum(phi ** (2 * i) for i in range(h))) ** 0.5 for h in range(1, horizons + 1)]

    t, v = F.col(time_col).cast("double"), F.col(value).cast("double")
    trends = indicators.where(F.col(code).isin(codes)).groupBy(area, code).agg(
        F.regr_slope(v, t).alias("__slope"), F.regr_intercept(v, t).alias("__at0"), F.avg(v).alias("__avg"))
    of = lambda table: F.coalesce(*[F.when(F.col(code) == c, F.lit(x)) for c, x in table.items()])
    last = start.agg(F.max(time_col)).scalar()
    line = lambda h: F.coalesce(F.col("__at0") + F.col("__slope") * (last + h).cast("double"), F.col("__avg"))
    effects = trends.groupBy(area).agg(*[F.sum(of(weight) * (line(h) - of(mean))).alias(f"__u{h}") for h in range(1, horizons + 1)])
    rows = start.join(effects, area, "left")
    effect = F.array(*[F.lit(constant) + F.coalesce(F.col(f"__u{h}"), F.lit(0.0)) for h in range(1, horizons + 1)])
    path = F.aggregate(
        effect, F.struct(F.col(share).cast("double").alias("last"), F.array().cast("array<double>").alias("path")),
        lambda acc, u: F.struct((u + phi * acc["last"]).alias("last"), F.concat(acc["path"], F.array(u + phi * acc["last"])).alias("path")),
        lambda acc: acc["path"])
    bands = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(name).alias("band"), F.lit(sign * widths[h - 1]).alias("__off"))
                      for h in range(1, horizons + 1) for name, sign in (("low", -1.0), ("central", 0.0), ("high", 1.0))])
    out = rows.select(*keys, F.col(time_col), path.alias("__path"), F.inline(bands))
    return out.select(*keys, "horizon", (F.col(time_col) + F.col("horizon")).alias("period"), "band",
                      F.greatest(F.lit(low), F.least(F.lit(high), F.col("__path")[F.col("horizon") - 1] + F.col("__off"))).alias(share))


def compare_tree_models(df: DataFrame, features: Sequence[str], label: str, time_col: str,
                        test_periods: Sequence, kinds=("forest", "gbt")) -> DataFrame:
    """M6: expanding-window evaluation of Spark ML models.  For each test period p (a short, bounded list), every
    model is fit on periods < p and scored on p.  Returns (model, period, n, mae, rmse, r2)."""
    from functools import reduce

    frames = []
    df = cut_lineage(df)  # every fit and every score reads the same rows
    for p in test_periods:
        train, test = temporal_split(df, time_col, p)
        models = fit_regressors(train, features, label, kinds)
        test_x = test.select(*[F.col(c).cast("double").alias(c) for c in features],
                             F.col(label).cast("double").alias(label))
        for kind, model in models.items():
            m = regression_metrics(model.transform(test_x), label, "prediction")
            frames.append(m.select(F.lit(kind).alias("model"), F.lit(p).alias("period"), "*"))
    return reduce(lambda a, b: a.unionByName(b), frames)
