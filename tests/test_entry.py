import importlib

import duckdb

from conftest import SF


def test_contract_keys():
    entry = importlib.import_module("__spark_entry__")
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def _compare(spark, name):
    entry = importlib.import_module("__spark_entry__")
    df = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    from tabforge.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    norm = lambda r, cs: tuple(r[cs.index(c)] for c in sorted(cs))
    a = sorted(map(repr, (norm(tuple(r), df.columns) for r in df.collect())))
    b = sorted(map(repr, (norm(r, cols) for r in res.fetchall())))
    assert a == b


def test_oracles_small(spark):
    for name in ("indicators", "merge_levels", "fill_group_median", "quantiles", "robust_scale",
                 "knn_impute", "equal_width_bins", "one_hot", "ridge_fit", "engineered"):
        _compare(spark, name)


def test_oracle_sql_needs_no_session():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; print(len(e.oracle_sql()), len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
