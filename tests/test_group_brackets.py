"""Grouped quantiles and quantiles of fold complements against numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import brackets, group_brackets
from tabforge.operators.group_brackets import group_quantiles

PROBS = [0.0, 0.0042, 0.25, 0.5, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def _rows(kind, n=6000):
    rng = np.random.default_rng(5)
    g = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n))
    v = {"smooth": rng.lognormal(3, 1, n), "ties": np.floor(rng.exponential(1.5, n)),
         "one": np.full(n, 2.5), "spike": np.where(rng.random(n) < 0.9, 7.0, rng.normal(0, 1e6, n))}[kind]
    return g, v


@pytest.mark.parametrize("kind", ["smooth", "ties", "one", "spike"])
def test_hot_groups_match_numpy(spark, kind):
    g, v = _rows(kind)
    df = spark.createDataFrame([(None if a == 0 else int(a), float(b)) for a, b in zip(g, v)],
                               "g int, v double").repartition(5)
    got = {r.g: list(r)[1:] for r in
           group_quantiles(df, "v", PROBS, ["g"], NAMES, list_rows=40, max_hot=50).collect()}
    assert len(got) == len(set(g.tolist()))
    for key in set(g.tolist()):
        assert np.allclose(got[key or None], np.quantile(v[g == key], PROBS), rtol=1e-12, atol=0)


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 1.0), ("b", 2.0), (None, 5.0)],
                               "g string, v double")
    got = {r.g: r.m for r in group_quantiles(df, "v", [0.5], ["g"], ["m"]).collect()}
    assert got == {"b": 1.5, None: 5.0}
    assert group_quantiles(df.limit(0), "v", [0.5], ["g"], ["m"]).collect() == []


def test_hot_rows_are_not_sorted_by_range(spark):
    g, v = _rows("smooth", 2000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    plan = group_quantiles(df, "v", [0.5], ["g"], ["m"])._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()


@pytest.mark.parametrize("kind", ["smooth", "ties", "one", "spike"])
@pytest.mark.parametrize("layout", ["even", "sorted"])
def test_fold_complements_match_numpy(spark, monkeypatch, kind, layout):
    monkeypatch.setattr(brackets, "LIST_ROWS", 60)
    _, v = _rows(kind, 2500)
    fold = np.arange(len(v)) % 6 if layout == "even" else np.argsort(np.argsort(v)) * 6 // len(v)
    df = spark.createDataFrame([(int(k) if k < 5 else None, float(x)) for k, x in zip(fold, v)],
                               "k int, v double")
    got = brackets.complement_values(df, {"v": F.col("v")}, F.col("k"), 5, PROBS)
    for k in range(5):
        assert np.allclose(got["v", k], np.quantile(v[fold != k], PROBS), rtol=1e-12, atol=0)


def test_complement_without_values_is_absent(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, None)], "k int, v double")
    got = brackets.complement_values(df, {"v": F.col("v")}, F.col("k"), 2, [0.5])
    assert got == {("v", 1): [1.5]}
