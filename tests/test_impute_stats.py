import numpy as np
from pyspark.sql import functions as F

from tabforge.operators import impute, stats
from tabforge.operators.quantiles import column_quantiles, quantiles


def test_group_mode_and_median_fill(spark):
    # fixture `group_fill`: ties, all-NULL group, NULL key
    rows = [(1, "a", "x", 1.0), (2, "a", "y", 2.0), (3, "a", None, None), (4, "b", None, None),
            (5, "b", None, 4.0), (6, None, None, None), (7, "c", "z", 10.0), (8, "c", "z", 20.0),
            (9, "c", "w", 30.0), (10, "c", None, None)]
    df = spark.createDataFrame(rows, "id int, g string, v string, x double")
    m = {r.id: r.v for r in impute.fill_group(df, "v", "g", stat="mode").collect()}
    assert m[3] == "x"          # tie x/y -> smallest (N9)
    assert m[4] is None         # all-NULL group stays NULL
    assert m[6] is None         # NULL key keeps its value (N8)
    assert m[10] == "z"
    med = {r.id: r.x for r in impute.fill_group(df, "x", "g", stat="median").collect()}
    assert med[3] == 1.5 and med[4] == 4.0 and med[10] == 20.0 and med[6] is None


def test_mode_imputer_ties_smallest(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("b", 1), ("a", 1), (None, None)], "s string, n int")
    model = impute.fit_mode_imputer(df, ["s", "n"])
    assert model.values == {"s": "a", "n": "1"}
    last = model.transform(df).collect()[-1]
    assert (last.s, last.n) == ("a", 1)


def test_quantiles_fixture(spark):
    # fixture `quant`: 1, 2, 4, 100 -> q0.9 = 71.2; population skew 1.15245023963
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,)], "v double")
    assert abs(quantiles(df, "v", [0.9]).first()[0] - 71.2) < 1e-9
    sk = stats.skew_report(df, ["v"]).first()["skew"]
    assert abs(sk - 1.15245023963) < 1e-9


def test_quantiles_hot_group_matches_numpy(spark):
    rng = np.random.default_rng(1)
    g = np.where(rng.random(3000) < 0.6, 0, rng.integers(1, 20, 3000))   # one hot group
    v = np.round(rng.lognormal(3, 1, 3000), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    probs = [0.0042, 0.25, 0.5, 0.99]
    for parts in (1, 7):
        got = {r.g: [r[f"q_{i}"] for i in range(4)]
               for r in quantiles(df.repartition(parts), "v", probs, by=["g"]).collect()}
        for key, vals in got.items():
            exp = np.quantile(v[g == key], probs)
            assert np.allclose(vals, exp, rtol=0, atol=1e-9)


def test_column_quantiles(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(10)], "a double, b double")
    got = {r.feature: (r.q_0, r.q_1) for r in column_quantiles(df, ["a", "b"], [0.25, 0.5]).collect()}
    assert got["a"] == (2.25, 4.5) and got["b"] == (0.0, 1.0)


def test_pairwise_complete_corr(spark):
    # fixture `corr`: r = 0.8660254
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, None), (None, 5.0), (4.0, 3.5)],
                               "a double, b double")
    r = stats.corr_long(df, ["a", "b"]).first()["r"]
    assert abs(r - 0.8660254) < 1e-7


def test_correlated_pairs_and_greedy_drop(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    rows = [(float(a), float(a * 2 + 0.01 * b), float(c), float(-a + 0.01 * c))
            for a, b, c in zip(x, rng.normal(size=200), rng.normal(size=200))]
    df = spark.createDataFrame(rows, "x double, y double, z double, w double")
    pairs = [(r.a, r.b) for r in stats.correlated_pairs(df, ["x", "y", "z", "w"]).collect()]
    assert set(pairs) == {("x", "y"), ("w", "x"), ("w", "y")}
    # only r > t counts for the greedy drop (w is negatively correlated)
    assert stats.drop_correlated(df, ["x", "y", "z", "w"]) == ["x"]


def test_null_report_profile_level_diff(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "a")], "k int, s string")
    rep = {r.feature: r.nulls for r in stats.null_report(df).collect()}
    assert rep == {"k": 1, "s": 1}
    p = stats.profile(df, "s").first()
    assert (p.n_values, p.n_null, p.n_rows) == (2, 1, 3)
    other = spark.createDataFrame([("a",)], "s string")
    assert [r.level for r in stats.level_diff(df, other, "s").collect()] == [None]
    assert abs(stats.geo_mean(spark.createDataFrame([(1.0,), (100.0,)], "v double"), "v")
               .first()[0] - 10.0) < 1e-12


def test_approximate_quantiles_opt_in(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "v double")
    q = quantiles(df, "v", [0.5, 0.9], approx=10000).first()
    assert abs(q.q_0 - 500) <= 1 and abs(q.q_1 - 900) <= 1


def test_corr_from_gram_equals_pairwise_on_complete_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x[:, 1] += 2 * x[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    a = {(r.a, r.b): r.r for r in stats.corr_long(df, ["a", "b", "c", "d"]).collect()}
    b = {(r.a, r.b): r.r for r in stats.corr_long(df, ["a", "b", "c", "d"], complete_rows=True).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
