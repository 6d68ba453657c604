"""Bracket quantiles against numpy, with heavy ties, long tails, NULL and NaN."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import brackets
from tabforge.operators.quantiles import column_quantiles, quantiles

PROBS = [0.0, 0.0042, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("listed", [3, 50_000])
def test_against_numpy(spark, monkeypatch, listed):
    monkeypatch.setattr(brackets, "LIST_ROWS", listed)
    rng = np.random.default_rng(0)
    for n in (1, 2, 10, 3000):
        pdf = pd.DataFrame({
            "wide": np.exp(rng.normal(size=n) * 20), "few": rng.integers(0, 3, n).astype(float),
            "two": np.where(rng.random(n) < 0.5, 1.0, 2.0),
            "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.random(n))})
        df = spark.createDataFrame(pdf).repartition(4)
        got = brackets.quantile_values(df, {c: F.col(c) for c in pdf}, PROBS)
        for c in pdf:
            v = pdf[c].dropna()
            assert (c in got) == bool(len(v))
            if len(v):
                np.testing.assert_allclose(got[c], v.quantile(PROBS), rtol=1e-12)


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert quantiles(df, "a", [0.5]).collect() == []
    assert [(r.feature, r.q_0) for r in column_quantiles(df, ["a", "b"], [0.5]).collect()] == [("b", 1.5)]


def test_span_counts_per_fold_against_brute_force(spark):
    import random

    from tabforge.operators.brackets import _span_counts
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice([None, float(rng.randrange(20))]), float(rng.randrange(9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, x0 double, x1 double").repartition(4)
    spans = [(0, 2.0, 17.0, 5.0, 9.0), (0, 0.0, 19.0, 8.0, 8.0), (1, 0.0, 8.0, 3.5, 3.6), (1, 4.0, 4.0, 4.0, 4.0)]
    got = {(r["k"], r["j"]): tuple(r)[2:] for r in _span_counts(df, spans, F.col("k"))}
    for k in range(3):
        for j, (i, a, b, lo, hi) in enumerate(spans):
            v = [r[1 + i] for r in rows if r[0] == k and r[1 + i] is not None]
            left, mid, right = ([x for x in v if a <= x < lo], [x for x in v if lo <= x <= hi],
                                [x for x in v if hi < x <= b])
            assert got[k, j] == (len(left), len(mid), len(right), min(mid, default=None), max(mid, default=None),
                                 max(left, default=None), min(right, default=None))
