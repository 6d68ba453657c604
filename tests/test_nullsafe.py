from pyspark.sql import functions as F

from tabforge.functions.nullsafe import eq_flag, gt_flag, isin_flag, ne_flag, qcol, safe_name


def test_pandas_comparison_semantics(spark):
    # fixture `compare`: equal, different, one NULL, both NULL
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (None, None)], "a int, b int")
    rows = df.select(eq_flag("a", F.col("b")).alias("eq"), ne_flag("a", F.col("b")).alias("ne"),
                     gt_flag("a", 0).alias("gt"), isin_flag("a", [1, 3]).alias("isin")).collect()
    assert [r.eq for r in rows] == [1, 0, 0, 0]          # N1
    assert [r.ne for r in rows] == [0, 1, 1, 1]          # N2: NULL vs NULL is 1
    assert [r.gt for r in rows] == [1, 1, 0, 0]          # N3
    assert [r.isin for r in rows] == [1, 1, 0, 0]        # N4


def test_odd_names(spark):
    df = spark.createDataFrame([(1,)], "`H_2.5Fin` int")
    assert df.select(qcol("H_2.5Fin")).first()[0] == 1
    assert safe_name("MSZoning_C (all)") == "MSZoning_C_all_"
