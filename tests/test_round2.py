"""Cases that used to give wrong or silent results."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models.ensemble import EnsembleConfig, fit_stack
from tabforge.operators import frame, impute, stats, transform
from tabforge.sources.tables import nan_to_null


def test_correlation_with_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (None, 1.0, 5.0)],
                               "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in stats.corr_long(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("b", "c")] is None
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1], abs=1e-12)


def test_update_with_a_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0)], "k int, v double")
    other = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k int, v double")
    with pytest.raises(ValueError):
        frame.update_from(df, other, "k")


def test_mode_of_dates_and_large_integers(spark):
    day = datetime.date
    df = spark.createDataFrame([(day(2020, 1, 2), 2**53 + 1), (day(2019, 5, 1), 2**53), (None, None)],
                               "d date, n long")
    model = impute.fit_mode_imputer(df, ["d", "n"])
    filled = model.transform(df).where("d is not null").collect()
    assert (day(2019, 5, 1), 2**53) in {(r.d, r.n) for r in filled}
    assert model.transform(df).where((F.col("d") == day(2019, 5, 1)) & (F.col("n") == 2**53)).count() == 2


def test_lambda_beyond_the_first_range(spark):
    rng = np.random.default_rng(0)
    x = np.clip(1 + rng.normal(10, 0.3, 400), 1e-3, None) ** (1 / 9.0) - 1
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    fit = transform.fit_lambdas(df, ["x"])
    assert fit.lambdas["x"] > 5.5
    with pytest.raises(ValueError):
        transform.fit_lambdas(spark.createDataFrame([(-1.5,), (2.0,), (3.0,)], "x double"), ["x"])


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, 2), (None, 3)], "x double, k int")
    assert [r.x for r in nan_to_null(df).orderBy("k").collect()] == [None, 2.0, None]


def test_stack_sees_features(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    rows = [(i, float(a), float(b), float(2 * a - b + rng.normal(0, 0.1))) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y double")
    cfg = EnsembleConfig(stack_folds=3, gbt_trees=0)
    model = fit_stack(df, "k", ["a", "b"], "y", cfg)
    assert model.meta.features[:2] == ["a", "b"] and len(model.meta.features) == 6
    err = model.transform(df).select(F.avg(F.pow(F.col("pred_stack") - F.col("y"), 2))).first()[0]
    assert err < 0.05
    cfg.use_features_in_secondary = False
    assert len(fit_stack(df, "k", ["a", "b"], "y", cfg).meta.features) == 4
