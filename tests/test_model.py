"""Regressors on the training set: linear coefficients, forest and boosted trees, series without values."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import model as M


def rows(spark, n=200):
    return spark.range(n).select(
        F.col("id").alias("yr"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        F.lit(None).cast("double").alias("never"),
        (F.lit(3.0) + 2.0 * (F.col("id") % 17) - (F.col("id") % 5)).alias("y"))


def test_linear_coefficients(spark):
    model = M.fit_regressors(rows(spark), ["a", "b"], "y", kinds=("linear",))["linear"].stages[-1]
    assert list(model.coefficients) == pytest.approx([2.0, -1.0], abs=1e-6) and model.intercept == pytest.approx(3.0, abs=1e-6)


def test_three_regressors_and_a_series_without_values(spark):
    df = rows(spark)
    train, test = M.temporal_split(df, "yr", 199)
    models = M.fit_regressors(train, ["a", "b", "never"], "y")
    assert set(models) == {"linear", "forest", "gbt"}
    for m in models.values():
        pred = m.transform(train)
        r2 = M.regression_metrics(pred, "y", "prediction").first().r2
        assert r2 > 0.8
    assert models["gbt"].transform(test).count() == 1
    with pytest.raises(ValueError):
        M.fit_regressors(train, ["never"], "y", kinds=("linear",))
