"""Screened paths, lambda search far from one, empty tables, and the entry without optional parts."""

import sys
import time

import numpy as np
import pytest

from tabforge.models import linear, screening
from tabforge.models.ensemble import ENET_ALPHAS, ENET_L1_RATIOS, LASSO_ALPHAS
from tabforge.models.gram import FoldStats, Stats
from tabforge.operators import stats, transform


def _folds(n, d, folds=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ (np.eye(d) + 0.3 * rng.normal(size=(d, d)) / np.sqrt(d))
    y = x[:, :5] @ np.array([3.0, -2.0, 1.5, 1.0, -1.0]) + rng.normal(size=n)
    own = np.arange(n) % folds
    return FoldStats({k: Stats(float((own == k).sum()), x[own == k].sum(axis=0), float(y[own == k].sum()),
                               x[own == k].T @ x[own == k], x[own == k].T @ y[own == k],
                               float(y[own == k] @ y[own == k])) for k in range(folds)})


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.5, 1.0])
def test_paths_are_optimal(ratio):
    """Optimality conditions of every coordinate, screened out or not, along the whole path."""
    total = _folds(400, 30).total()
    g, c, _ = total.centered()
    alphas = [1e-4, 0.01, 0.05, 0.2, 1.0, 5.0]
    found = screening.path(g, c, total.n, ratio, alphas)
    for a, w in zip(alphas, found, strict=True):
        l1, l2 = total.n * a * ratio, total.n * a * (1 - ratio)
        grad = c - g @ w - l2 * w
        on = w != 0
        assert np.abs(grad[on] - l1 * np.sign(w[on])).max(initial=0) < 1e-6 * np.abs(c).max()
        assert (np.abs(grad[~on]) <= l1 + 1e-6 * np.abs(c).max()).all()
    if ratio == 1.0:
        assert (found != 0).sum(axis=1).min() < 10 < (found != 0).sum(axis=1).max()


def test_paths_with_dependent_and_constant_columns():
    total = _folds(300, 8).total()
    g, c, _ = total.centered()
    wide = np.zeros((10, 10))
    wide[:8, :8] = g
    wide[8, :8], wide[:8, 8], wide[8, 8] = g[0], g[:, 0], g[0, 0]      # column 8 repeats column 0
    c = np.concatenate([c, [c[0], 0.0]])                              # column 9 is constant
    for w, a in zip(screening.path(wide, c, 300.0, 1.0, [0.5, 0.1]), [0.5, 0.1], strict=True):
        grad = c - wide @ w
        assert (np.abs(grad) <= 300 * a * (1 + 1e-6)).all() and w[9] == 0


def test_tasks_agree_with_the_search_in_place(spark, monkeypatch):
    fs = _folds(400, 20)
    there = screening.cv_errors(fs, [0.01, 0.1, 1.0], [0.3, 1.0])
    monkeypatch.setattr(screening.SparkSession, "getActiveSession", classmethod(lambda cls: None))
    here = screening.cv_errors(fs, [0.01, 0.1, 1.0], [0.3, 1.0])
    assert np.array_equal(there, here)
    slow = linear.solve_enet(fs.train(0), 0.1, 0.3, tol=1e-12)[0]
    g, c, _ = fs.train(0).centered()
    assert np.allclose(screening.path(g, c, fs.train(0).n, 0.3, [0.1])[0], slow, atol=1e-8)


def test_reference_grids_at_250_features(spark, capsys):
    fs = _folds(3000, 250, folds=20, seed=3)
    t = time.time()
    a, _, lasso = linear.enet_cv(fs, LASSO_ALPHAS, (1.0,))
    b, r, enet = linear.enet_cv(fs, ENET_ALPHAS, ENET_L1_RATIOS)
    with capsys.disabled():
        print(f"\n20 folds x (109 + 702) fits of 250 features: {time.time() - t:.1f} s")
    assert lasso.shape == (1, 109) and enet.shape == (26, 27)
    assert np.isfinite(lasso).all() and np.isfinite(enet).all()
    assert lasso.min() < 1.3 and enet.min() < 1.3          # noise of variance 1 was added


def test_lambda_of_a_left_leaning_column_near_a_million(spark):
    x = 1e6 - 200 * np.random.default_rng(1).gamma(2.0, 1.0, 400)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    for method in ("mle", "pearsonr"):
        try:
            fit = transform.fit_lambdas(df, ["x"], method=method)
            assert fit.lambdas["x"] > 5 and np.isfinite(fit.scores["x"])
        except ValueError as e:
            assert "widenings" in str(e)


def test_lambda_of_a_constant_column_is_an_error(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    with pytest.raises(ValueError, match="constant"):
        transform.fit_lambdas(df, ["x"], method="mle")


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert tuple(stats.profile(df, "a").first()) == (0, 0, 0)


def test_entry_without_the_optional_subpackage(monkeypatch):
    import __spark_entry__ as entry
    every = set(entry.queries())
    monkeypatch.setitem(sys.modules, "tabforge.llm.queries", None)   # as if a library were missing
    assert "knn_impute" in entry.queries() and "knn_impute" in entry.oracle_sql()
    assert set(entry.queries()) <= every


def _brute_huber(x, y, rounds, depth, rate, min_leaf, min_split, alpha):
    """The booster by definition: every midpoint of every feature is tried."""
    total = np.full(len(y), np.median(y))
    for _ in range(rounds):
        r = y - total
        delta = np.quantile(np.abs(r), alpha)
        g = np.clip(r, -delta, delta)
        leaves, done = [np.arange(len(y))], []
        for _ in range(depth):
            split = []
            for rows in leaves:
                best = (0.0, None)
                for f in range(x.shape[1]):
                    values = np.unique(x[:, f])
                    for t in (values[1:] + values[:-1]) / 2:
                        left = x[rows, f] <= t
                        a, b = g[rows][left], g[rows][~left]
                        if min(len(a), len(b)) >= min_leaf and len(rows) >= min_split:
                            gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows)
                            if gain > best[0] + 1e-9:
                                best = (gain, left)
                split += [rows[best[1]], rows[~best[1]]] if best[1] is not None else []
                done += [rows] if best[1] is None else []
            leaves = split
        for rows in done + leaves:
            med = np.median(r[rows])
            diff = r[rows] - med
            total[rows] += rate * (med + np.mean(np.sign(diff) * np.minimum(np.abs(diff), delta)))
    return total


def test_huber_rounds_against_brute_force(spark):
    from tabforge.models.huber import fit_huber_gbt
    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, size=(300, 3)).astype(float)
    y = x[:, 0] * 3 - np.where(x[:, 1] > 5, 10, 0) + rng.standard_t(2, 300)
    df = spark.createDataFrame([(i, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(x, y))],
                               "id int, a double, b double, c double, y double").repartition(3)
    model = fit_huber_gbt(df, list("abc"), "y", n_trees=3, learning_rate=0.3, max_depth=2, min_leaf=15,
                          min_split=50, alpha=0.9, feature_subset="all")
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    want = _brute_huber(x, y, 3, 2, 0.3, 15, 50, 0.9)
    assert np.allclose([got[i] for i in range(300)], want, atol=1e-9)


def test_huber_bins_of_many_values_and_missing_ones(spark):
    from tabforge.models.huber import BINS, bin_thresholds, fit_huber_gbt
    from pyspark.sql import functions as F
    rng = np.random.default_rng(9)
    x = rng.normal(size=2000)
    df = spark.createDataFrame([(float(v) if i % 7 else None, 1.0, float(np.sin(v))) for i, v in enumerate(x)],
                               "a double, b double, y double")
    cuts = bin_thresholds(df.select(F.array(F.coalesce("a", F.lit(float("nan"))), "b").alias("_x")), 2)
    assert 200 < len(cuts[0]) < BINS and len(cuts[1]) == 0
    model = fit_huber_gbt(df, ["a", "b"], "y", n_trees=8, learning_rate=0.5, feature_subset="all")
    err = model.transform(df).where("a is not null").agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert err < 0.1
