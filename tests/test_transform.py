from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from tabforge.functions.normal import add_norm_ppf, norm_ppf
from tabforge.operators.transform import fit_lambdas, fit_skew_fix, llf_grid


def test_norm_ppf_matches_stdlib(spark):
    ps = [1e-12, 0.001, 0.02425, 0.3, 0.5, 0.8, 0.97575, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    a = [r.z for r in df.select(norm_ppf(F.col("p")).alias("z")).collect()]
    b = [r.z for r in add_norm_ppf(df, "p", "z").collect()]
    for p, x, y in zip(ps, a, b):
        e = NormalDist().inv_cdf(p)
        assert abs(x - e) < 1e-12 * max(1, abs(e)) and abs(y - e) < 1e-12 * max(1, abs(e))


def _bc(x, lam):
    return np.log(x) if abs(lam) < 1e-12 else (x ** lam - 1) / lam


def test_lambda_fits_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = np.round(rng.lognormal(1.0, 0.8, 400), 2)
    df = spark.createDataFrame([(float(a),) for a in v], "v double")
    x = v + 1.0
    n = len(x)
    u = np.empty(n)
    u[-1] = 0.5 ** (1 / n)
    u[0] = 1 - u[-1]
    u[1:-1] = (np.arange(2, n) - 0.3175) / (n + 0.365)
    z = np.array([NormalDist().inv_cdf(p) for p in u])
    grid = np.linspace(-2, 2, 8001)
    pear = grid[np.argmax([np.corrcoef(z, _bc(np.sort(x), g))[0, 1] for g in grid])]
    mle = grid[np.argmax([(g - 1) * np.log(x).sum() - n / 2 * np.log(_bc(x, g).var()) for g in grid])]
    assert abs(fit_lambdas(df, ["v"], method="pearsonr").lambdas["v"] - pear) < 2e-3
    assert abs(fit_lambdas(df, ["v"], method="mle").lambdas["v"] - mle) < 2e-3
    g = {r["lambda"]: r.llf for r in llf_grid(df, "v", [0.0, 0.5], shift=1.0).collect()}
    for lam in (0.0, 0.5):
        exp = (lam - 1) * np.log(x).sum() - n / 2 * np.log(_bc(x, lam).var())
        assert abs(g[lam] - exp) < 1e-6


def test_skew_fix_selects_positive_skew_only(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in zip(rng.lognormal(0, 1, 300), rng.normal(0, 1, 300))]
    df = spark.createDataFrame(rows, "skewed double, sym double")
    m = fit_skew_fix(df, ["skewed", "sym"])
    assert list(m.lambdas) == ["skewed"]
    after = m.transform(df).agg(F.skewness("skewed")).first()[0]
    assert abs(after) < abs(m.skew_before["skewed"])

    rep = {r.feature: r for r in m.report(df, ["skewed", "sym"]).collect()}
    assert rep["sym"]["lambda"] is None and abs(rep["skewed"].skew_after) < rep["skewed"].skew_before


def test_grid_task_sums_match_the_definition():
    import pyarrow as pa

    from tabforge.operators.transform import _grid_task
    x, w, z = np.array([0.5, 2.0, 7.0]), np.array([1.0, 3.0, 2.0]), np.array([-1.0, 0.25, 1.5])
    lam = np.array([-1.0, 0.0, 0.5])
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a"]), *map(pa.array, (x, w, z))],
                                       names=["feature", "x", "w", "z"])
    ybar = {"a": np.array([0.1, 0.2, 0.3]), "b": np.zeros(3)}
    [a, b] = sorted((r.to_pydict() for r in _grid_task(
        {"a": lam, "b": lam}, {"a": 0.4, "b": 0.0}, ybar)([batch])), key=lambda r: r["feature"][0])
    for out, at, f, shift in ((a, [0, 2], "a", 0.4), (b, [1], "b", 0.0)):
        for k, own in enumerate(lam):
            t = np.log(x[at]) - shift
            y = (t if own == 0 else (np.exp(own * t) - 1) / own) - ybar[f][k]
            want = (w[at] * y).sum(), (w[at] * y * y).sum(), (z[at] * y).sum()
            assert np.allclose((out["sy"][k], out["syy"][k], out["szy"][k]), want)
