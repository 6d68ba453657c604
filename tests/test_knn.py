import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.operators import neighbours
from tabforge.operators.knn import knn_impute


def brute_knn(x: np.ndarray, k: int) -> np.ndarray:
    """Reference definition: mean squared difference over co-observed features,
    1/d weights over the k nearest donors (ties by row index), zero distance
    -> mean of the zero-distance donors."""
    out = x.copy()
    n, d = x.shape
    for i in range(n):
        for j in range(d):
            if not np.isnan(x[i, j]):
                continue
            cand = []
            for r in range(n):
                if r == i or np.isnan(x[r, j]):
                    continue
                both = ~np.isnan(x[i]) & ~np.isnan(x[r])
                if not both.any():
                    continue
                cand.append((float(np.mean((x[i, both] - x[r, both]) ** 2)), r))
            cand.sort()
            top = cand[:k]
            if not top:
                continue
            zero = [x[r, j] for dist, r in top if dist == 0]
            if zero:
                out[i, j] = np.mean(zero)
            else:
                w = np.array([1 / dist for dist, _ in top])
                out[i, j] = float(np.dot(w, [x[r, j] for _, r in top]) / w.sum())
    return out


def _run(spark, x, k, cell_rows):
    rows = [(i, *(None if np.isnan(v) else float(v) for v in row)) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    out = knn_impute(df, "id", ["a", "b", "c"], k=k, cell_rows=cell_rows, slice_rows=7)
    got = {r.id: [np.nan if v is None else v for v in (r.a, r.b, r.c)] for r in out.collect()}
    return np.array([got[i] for i in range(len(x))])


def test_knn_fixture(spark):
    # fixture `knn`: 6 rows x 3 features, two NULLs, one exact duplicate (rows 0 and 1)
    x = np.array([[1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [1.0, 2.0, np.nan], [4.0, np.nan, 6.0],
                  [2.0, 3.0, 5.0], [9.0, 9.0, 9.0]])
    for k, cell_rows in ((10, 100), (2, 2)):
        got = _run(spark, x, k, cell_rows)
        assert np.allclose(got, brute_knn(x, k), equal_nan=True)
    assert _run(spark, x, 10, 1000)[2, 2] == 3.0      # zero-distance donors: their mean


def test_knn_random_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, size=(60, 3)).astype(float)
    x[rng.random(x.shape) < 0.15] = np.nan
    for cell_rows in (1000, 6):
        assert np.allclose(_run(spark, x, 5, cell_rows), brute_knn(x, 5), equal_nan=True)


def test_bounds_hold_for_every_donor_of_a_cell():
    rng = np.random.default_rng(6)
    for gaps in (0.0, 0.3):
        q, d = rng.normal(size=(40, 4)), rng.normal(size=(60, 4))
        q[rng.random(q.shape) < 0.3] = np.nan
        d[rng.random(d.shape) < gaps] = np.nan
        cell = rng.integers(0, 5, 60)
        low, high = (np.array([f(d[cell == c], axis=0) for c in range(5)]) for f in (np.nanmin, np.nanmax))
        gappy = np.array([np.isnan(d[cell == c]).any(axis=0) for c in range(5)])
        bound = neighbours.box_bounds(q, low, high, gappy)
        far = neighbours.distances(q, d)
        ok = np.isfinite(far)
        assert (bound[:, cell][ok] <= far[ok]).all()


def _table(spark, n, seed=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) @ rng.normal(size=(5, 5))
    x[:, 4] += 0.1 * rng.normal(size=n)
    gone = rng.random(n) < 0.1
    pdf = pd.DataFrame(x, columns=list("abcde")).assign(id=np.arange(n))
    pdf.loc[gone, "e"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("e", F.when(~F.isnan("e"), F.col("e")))
    return df, x, gone


def test_many_cells_and_the_hash_mode(spark):
    """Twenty thousand unblocked rows: exact answers from many cells, recall of the hash tables."""
    df, x, gone = _table(spark, 20_000)
    near = distances = neighbours.distances(x[gone][:, :4], x[~gone][:, :4])
    ids = np.flatnonzero(~gone)
    best = ids[np.argsort(near, axis=1, kind="stable")[:, :10]]
    d10 = np.sort(distances, axis=1)[:, :10]
    w = 1 / d10
    want = (w * x[best, 4]).sum(axis=1) / w.sum(axis=1)
    got = {r.id: r.e for r in knn_impute(df, "id", list("abcde"), ["e"], cell_rows=1500).collect()}
    assert np.allclose([got[i] for i in np.flatnonzero(gone)], want, rtol=1e-9)

    queries = df.where("e is null").select(F.col("id").alias("q"), F.lit(1).cast("long").alias("g"),
                                           F.array(*[F.col(c) for c in "abcd"]).alias("x"))
    donors = df.where("e is not null").select(
        F.lit(1).cast("long").alias("g"), F.array(*[F.col(c) for c in "abcd"]).alias("x"),
        F.array(F.struct(F.col("id").alias("key"), F.col("e").alias("v"))).alias("donors"))
    found = {r.q: {b["key"] for b in r.best} for r in neighbours.approximate_nearest(
        queries, donors, 4, 10, df.schema["id"].dataType, [0, 1, 2, 3], cell_rows=4000).collect()}
    assert len(found) == gone.sum() and all(len(f) == 10 for f in found.values())
    recall = np.mean([len(found[i] & set(b.tolist())) / 10 for i, b in zip(np.flatnonzero(gone), best)])
    assert recall >= 0.9
    filled = {r.id: r.e for r in knn_impute(df, "id", list("abcde"), ["e"], method="hash").collect()}
    assert np.corrcoef([filled[i] for i in np.flatnonzero(gone)], want)[0, 1] > 0.99


def test_no_row_per_pair_is_exchanged(spark, capsys):
    df, _, _ = _table(spark, 2000)
    knn_impute(df, "id", list("abcde"), ["e"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_blocks_with_nulls_and_unknown_methods(spark):
    df = spark.createDataFrame([(1, "p", 1.0, None), (2, "p", 1.0, 5.0), (3, None, 1.0, None), (4, "q", 2.0, None)],
                               "id int, g string, a double, b double")
    got = {r.id: r.b for r in knn_impute(df, "id", ["a", "b"], ["b"], block="g").collect()}
    assert got == {1: 5.0, 2: 5.0, 3: None, 4: None}
    with pytest.raises(ValueError, match="method"):
        knn_impute(df, "id", ["a", "b"], method="trees")


def test_donors_are_the_rows_that_meet_the_condition(spark):
    df = spark.createDataFrame([(1, "train", 1.0, 10.0), (2, "train", 2.0, 20.0), (3, "test", 1.5, 99.0),
                                (4, "test", 1.5, None)], "id int, _split string, a double, b double")
    got = knn_impute(df, "id", ["a", "b"], ["b"], k=1, donors=F.col("_split") == "train")
    rows = {r.id: r.b for r in got.collect()}
    assert rows[3] == 99.0 and rows[4] in (10.0, 20.0)
    assert {r.id: r.b for r in knn_impute(df, "id", ["a", "b"], ["b"], k=1).collect()}[4] == 99.0
