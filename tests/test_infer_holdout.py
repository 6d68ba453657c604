"""Schema inference of CSV files; hold-outs from bucketed statistics against refits on the rows."""
import numpy as np
import pytest

from tabforge.models.evaluate import held_buckets, linear_holdout
from tabforge.sources.tables import infer_schema, read_csv


def _csv(tmp_path, text, name="a.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_types_are_the_narrowest_that_hold_all_values(spark, tmp_path):
    path = _csv(tmp_path, "w,r,mix,b,d,ts,s,none,big,code,a.b\n"
                "1,1.5,3,True,2020-01-02,2020-01-02 03:04:05,x,NA,123456789012345678901,10D,007\n"
                "-2,NA,.5,false,NA,2020-01-02,NA,NA,4,5, 1\n"
                "NA,1e3,NaN,NA,2020-02-29,NA,7,,5,6,2\n")
    got = {f.name: f.dataType.simpleString() for f in infer_schema(spark, path).fields}
    assert got == {"w": "bigint", "r": "double", "mix": "double", "b": "boolean", "d": "date",
                   "ts": "timestamp", "s": "string", "none": "string", "big": "string",
                   "code": "string", "a.b": "string"}
    rows = read_csv(spark, path).collect()
    assert sorted((r.w is None, r.w) for r in rows if r.w) == [(False, -2), (False, 1)]
    assert {r.mix for r in rows} == {3.0, 0.5, None} and {r.b for r in rows} == {True, False, None}


def test_impossible_dates_are_text_and_files_merge(spark, tmp_path):
    _csv(tmp_path, "d,n\n2021-02-30,1\n")
    path = _csv(tmp_path, "d,n\n2021-02-03,2.5\n", "b.csv")
    got = {f.name: f.dataType.simpleString() for f in infer_schema(spark, path).fields}
    assert got == {"d": "string", "n": "double"}


def test_own_timestamp_format(spark, tmp_path):
    path = _csv(tmp_path, "t\n03/02/2021 04:05\nNA\n")
    assert infer_schema(spark, path).simpleString() == "struct<t:string>"
    fmt = "dd/MM/yyyy HH:mm"
    assert infer_schema(spark, path, timestamp_format=fmt).simpleString() == "struct<t:timestamp>"
    assert str(read_csv(spark, path, timestamp_format=fmt).where("t is not null").first().t) == "2021-02-03 04:05:00"


def test_files_without_rows_are_text(spark, tmp_path):
    assert infer_schema(spark, _csv(tmp_path, "a,b\n")).simpleString() == "struct<a:string,b:string>"


def test_halves_differ_and_have_their_size():
    halves = [frozenset(held_buckets(r, 0.5)) for r in range(100)]
    assert {len(h) for h in halves} == {50} and len(set(halves)) == 100


def test_bucketed_holdout_equals_refits_on_rows(spark):
    rng = np.random.default_rng(3)
    n = 800
    x = np.column_stack([rng.normal(1e4, 3, n), rng.lognormal(0, 1, n)])
    y = np.exp(0.1 * (x[:, 0] - 1e4) + 0.3 * x[:, 1] + rng.normal(0, 0.1, n) + 5)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "id long, a double, b double, y double")
    per, summary = linear_holdout(df, "id", ["a", "b"], "y", repeats=4, fold_method="mod",
                                  grids={"ridge": ([7.0], None), "bayes": (None, None)})
    got = {(r.base, r.repeat): r.rmsle for r in per.collect()}
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    z, t = (x - q[1]) / (q[2] - q[0]), np.log1p(y)
    for r in range(4):
        held = np.isin(np.arange(n) % 101, list(held_buckets(r, 0.5)))
        zc, m = z[~held] - z[~held].mean(0), t[~held].mean()
        w = np.linalg.solve(zc.T @ zc + 7 * np.eye(2), zc.T @ (t[~held] - m))
        pred = m + (z[held] - z[~held].mean(0)) @ w
        assert abs(got["ridge", r] - np.sqrt(np.mean((t[held] - pred) ** 2))) < 1e-7
    assert {r.base: r.n for r in summary.collect()} == {"ridge": 4, "bayes": 4}


def test_searched_grids_and_refused_settings(spark):
    df = spark.createDataFrame([(i, float(i % 17), float(i % 5), 10.0 + i % 17) for i in range(300)],
                               "id long, a double, b double, y double")
    per, _ = linear_holdout(df, "id", ["a", "b"], "y", repeats=2, cv_folds=4,
                            grids={"ridge": ([0.1, 10.0], None), "enet": ([0.001, 0.1], [0.2, 1.0])})
    assert per.count() == 4 and all(0 <= r.rmsle < 1 for r in per.collect())
    with pytest.raises(ValueError):
        linear_holdout(df, "id", ["a"], "y", repeats=101)
    with pytest.raises(ValueError):
        linear_holdout(df.where("id = 0"), "id", ["a"], "y", repeats=1)
