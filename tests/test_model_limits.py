"""Limits, NULLs and sizes that must not pass silently."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models import linear as lin
from tabforge.models.ensemble import BLEND_WEIGHTS, EnsembleModel
from tabforge.models.gram import Stats, gram_stats
from tabforge.operators import impute
from tabforge.operators.joins import attach


def test_null_rows_are_an_error_unless_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 1.0), (2.0, 5.0)], "x double, y double")
    with pytest.raises(ValueError, match="2 rows"):
        gram_stats(df, ["x"], "y")
    assert gram_stats(df, ["x"], "y", nulls="skip").total().n == 2


def test_moments_of_a_far_column_keep_their_digits(spark):
    rng = np.random.default_rng(0)
    x = 2e7 + rng.normal(size=500)
    y = 3 * (x - 2e7) + rng.normal(size=500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    s = gram_stats(df, ["x"], "y").total()
    g, c, _ = s.centered()
    xc = x - x.mean()
    assert g[0, 0] == pytest.approx(xc @ xc, rel=1e-9) and c[0] == pytest.approx(xc @ y, rel=1e-9)
    w, b = lin.solve_ridge(s, 1.0)
    assert s.sse(w, b) == pytest.approx(np.sum((y - x * w[0] - b) ** 2), rel=1e-6)


def test_unfinished_iterations_warn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    y = x @ [1.0, 2.0, 3.0]
    s = Stats(50, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y)
    with pytest.warns(lin.NotConverged):
        lin.solve_enet(s, 0.1, 0.5, max_iter=1)
    with pytest.warns(lin.NotConverged):
        lin.solve_bayes_ridge(s, n_iter=1)


def test_blend_without_trees_shares_out_their_weight():
    w = EnsembleModel([], {}, None, None).blend_weights()
    assert "pred_gbt" not in w and sum(w.values()) == pytest.approx(1.0)
    assert w["pred_stack"] / w["pred_ridge"] == pytest.approx(0.35 / 0.15)
    assert EnsembleModel([], {}, object(), None).blend_weights() == pytest.approx(BLEND_WEIGHTS)


def test_promised_bounds_are_counted(spark):
    rows = spark.range(5)
    with pytest.raises(ValueError, match="promised"):
        attach(rows, spark.range(3), on="id", bound=2)


def test_group_fill_does_not_shuffle_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"),
                                  F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    out = impute.fill_group(df, "v", "g", stat="median")
    assert "Exchange hashpartitioning(g" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("v is null").count() == 0
