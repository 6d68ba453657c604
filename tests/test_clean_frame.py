from pyspark.sql import functions as F

from tabforge.operators import clean, frame
from tabforge.plans.column_plan import ColumnPlan


def test_drop_where_keeps_null_predicates(spark):
    df = spark.createDataFrame([(1, 4, 300000), (2, 4, 100), (3, None, 300000)], "id int, q int, p int")
    out = clean.drop_where(df, F.col("q") < 5, F.col("p") > 200000)
    assert sorted(r.id for r in out.collect()) == [2, 3]


def test_drop_keys_patch_update(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k int, s string, x double")
    assert sorted(r.k for r in clean.drop_keys(df, [2], "k").collect()) == [1, 3]
    p = clean.patch_cells(df, [(2, "x", 9.0), (3, "s", "z")], "k")
    assert {r.k: (r.s, r.x) for r in p.collect()} == {1: ("a", 1.0), 2: ("b", 9.0), 3: ("z", 3.0)}
    other = spark.createDataFrame([(1, None), (3, 30.0), (4, 40.0)], "k int, x double")
    u = frame.update_from(df, other, "k", ["x"])
    assert {r.k: r.x for r in u.collect()} == {1: 1.0, 2: None, 3: 30.0}
    r = clean.replace_values(df, {"a": "A"}, ["s"])
    assert [x.s for x in r.orderBy("k").collect()] == ["A", "b", "c"]


def test_column_plan(spark):
    import pytest
    df = spark.createDataFrame([(1, "a", 2.0, "x")], "id int, c string, n double, gone string")
    plan = ColumnPlan(key="id").add("one_hot", "c").add("numeric", "n").add("drop", "gone")
    plan.validate(df, raw_columns=df.columns)
    assert plan.apply(df).columns == ["id", "c", "n"]
    with pytest.raises(AssertionError):
        ColumnPlan(key="id").add("numeric", "n").validate(df, raw_columns=df.columns)
    with pytest.raises(KeyError):
        frame.drop_strict(df, ["nope"])
