import numpy as np

from tabforge.models import linear as lin
from tabforge.models.gram import gram_stats


def _frame(spark, n=200, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * np.array([1.0, 10.0, 0.1])
    y = x @ np.array([2.0, -0.3, 5.0]) + 1.0 + rng.normal(size=n)
    rows = [(i, i % 5, float(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, fold int, y double, a double, b double, c double")
    return df, x, y


def test_gram_stats_and_fold_complements(spark):
    df, x, y = _frame(spark)
    fs = gram_stats(df.repartition(6), ["a", "b", "c"], "y", "fold", fanin=2)
    tot = fs.total()
    sxx, sxy = tot.moments()
    assert np.allclose(sxx, x.T @ x) and np.allclose(sxy, x.T @ y) and tot.n == 200
    tr = fs.train(2)
    m = np.arange(200) % 5 != 2
    assert np.allclose(tr.moments()[0], x[m].T @ x[m]) and tr.n == m.sum()


def test_ridge_closed_form(spark):
    # fixture `ridge`: unequal scales, alpha 7
    df, x, y = _frame(spark)
    model = lin.fit_ridge(df, ["a", "b", "c"], "y", alpha=7.0)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    assert np.allclose(model.coef, w) and abs(model.intercept - (y.mean() - x.mean(0) @ w)) < 1e-9


def test_lasso_and_enet_kkt(spark):
    df, x, y = _frame(spark)
    n = len(y)
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha, rho in ((0.1, 1.0), (0.5, 0.3), (3.0, 1.0)):
        m = lin.fit_elastic_net(df, ["a", "b", "c"], "y", alpha=alpha, l1_ratio=rho)
        w = m.coef
        grad = xc.T @ (yc - xc @ w) / n - alpha * (1 - rho) * w
        for j in range(3):
            if w[j] != 0:
                assert abs(grad[j] - alpha * rho * np.sign(w[j])) < 1e-5
            else:
                assert abs(grad[j]) <= alpha * rho + 1e-6


def test_bayes_ridge_fixed_point(spark):
    df, x, y = _frame(spark)
    m = lin.fit_bayes_ridge(df, ["a", "b", "c"], "y")
    a, lam = m.params["alpha_"], m.params["lambda_"]
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + (lam / a) * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coef, w, atol=1e-6)
    assert 0.5 < 1 / a < 2.0                          # noise variance ~ 1


def test_cv_selects_from_grid(spark):
    df, _, _ = _frame(spark)
    fs = gram_stats(df, ["a", "b", "c"], "y", "fold")
    best, scores = lin.ridge_cv(fs, [0.1, 1.0, 1000.0])
    assert best in (0.1, 1.0) and len(scores) == 3
    a, r, s = lin.enet_cv(fs, [0.001, 0.01, 10.0], [0.5, 1.0])
    assert a in (0.001, 0.01) and s.shape == (2, 3)


def test_pair_stats_marginals_equal_separate_passes(spark):
    df, _, _ = _frame(spark)
    from pyspark.sql import functions as F
    pair = gram_stats(df.withColumn("p", F.col("fold") * 3 + F.col("id") % 3), ["a", "b", "c"], "y", "p")
    by_fold = pair.marginal(lambda p: p // 3)
    direct = gram_stats(df, ["a", "b", "c"], "y", "fold")
    for k in direct.folds:
        assert np.allclose(by_fold.folds[k].moments()[0], direct.folds[k].moments()[0])
        assert by_fold.folds[k].n == direct.folds[k].n
