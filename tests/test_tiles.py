"""Masked correlations against pandas."""
import numpy as np
import pandas as pd
import pytest

from tabforge.operators import stats, tiles


def _frame(n=300, d=9):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (n, d)) @ rng.normal(0, 1, (d, d)) + 1e6
    x[rng.random((n, d)) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c.{i}" for i in range(d)])
    pdf["const"] = 0.1
    pdf["none"] = np.nan
    pdf["alone"] = np.where(np.arange(n) == 5, 2.0, np.nan)
    # varies only in rows where `thin` is missing, and stays far from its mean elsewhere
    pdf["thin"] = np.where(np.arange(n) < 20, np.arange(n) * 1.0, np.nan)
    pdf["part"] = np.where(np.arange(n) < 20, 1e9, np.arange(n) * 1.0)
    # nearly constant far from its mean where `thin` is present
    pdf["near"] = np.where(np.arange(n) < 20, 1e9 + np.arange(n) ** 2, np.arange(n) * 1.0)
    return pdf


@pytest.mark.parametrize("band", [None, 5])
def test_pairwise_complete_like_pandas(spark, band):
    pdf = _frame()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(40)
    got = {(r.a, r.b): r.r for r in tiles.masked_correlations(df, list(pdf.columns), band).collect()}
    assert len(got) == len(pdf.columns) * (len(pdf.columns) - 1) // 2
    for (a, b), r in got.items():
        both = pdf[[a, b]].dropna()
        if len(both) < 2 or both[a].nunique() < 2 or both[b].nunique() < 2:
            assert r is None, (a, b)
        else:
            assert abs(r - np.corrcoef(both[a], both[b])[0, 1]) < 1e-7, (a, b)


def test_empty_tables_and_single_columns(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in tiles.masked_correlations(df, ["a", "b"]).collect()] == [("a", "b", None)]
    assert tiles.masked_correlations(df, ["a"]).collect() == []


def test_wide_tables(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 300))
    x[:, 299] = x[:, 0] + 1e-3 * x[:, 1]
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(300)]))
    assert stats.drop_correlated(df, ["c0", "c1", "c299"], 0.75) == ["c0"]
    wide = tiles.masked_correlations(df, df.columns)
    assert wide.count() == 44850
    assert abs(wide.where("a = 'c0' and b = 'c299'").first().r - np.corrcoef(x[:, 0], x[:, 299])[0, 1]) < 1e-9
