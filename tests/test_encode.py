from pyspark.sql import functions as F

from tabforge.operators import encode

QUALITIES = {"None": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}


def test_ordinal(spark):
    # fixture `ordinal`: all keys, an unknown key, NULL, literal 'None'
    vals = list(QUALITIES) + ["XX", None]
    df = spark.createDataFrame([(v,) for v in vals], "q string")
    got = [r.c for r in df.select(encode.ordinal("q", QUALITIES).alias("c")).collect()]
    assert got == [0, 1, 2, 3, 4, 5, None, None]


def test_equal_width_like_pandas_cut(spark):
    # fixture `bins` (values measured with pandas.cut(x, 7, labels=False))
    df = spark.createDataFrame([(1872,), (1891,), (1892,), (1950,), (2010,)], "y int")
    m = encode.fit_equal_width(df, "y", 7)
    assert [r.b for r in df.select(m.expr().alias("b")).collect()] == [0, 0, 1, 3, 6]
    const = spark.createDataFrame([(5,), (5,)], "y int")
    mc = encode.fit_equal_width(const, "y", 7)
    assert [r.b for r in const.select(mc.expr().alias("b")).collect()] == [3, 3]


def test_range_bins(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (4.0,), (6.5,), (10.0,), (11.0,), (None,)], "q double")
    b = encode.range_bins("q", [(1, 4, 1), (4, 7, 2), (7, 11, 3)])
    assert [r.b for r in df.select(b.alias("b")).collect()] == [1, 1, 2, None, 3, None, None]


def test_one_hot_odd_names_and_null(spark):
    # fixture `odd_names`
    df = spark.createDataFrame([(1, "2.5Fin"), (2, "C (all)"), (3, "Tar&Grv"), (4, "Wd Sdng"), (5, None)],
                               "id int, c string")
    m = encode.fit_one_hot(df, ["c"])
    out = m.transform(df)
    assert out.columns == ["id", "c_2.5Fin", "c_C (all)", "c_Tar&Grv", "c_Wd Sdng"]
    rows = {r[0]: tuple(r[1:]) for r in out.collect()}
    assert rows[1] == (1, 0, 0, 0) and rows[5] == (0, 0, 0, 0)


def test_int_levels_cast_to_string(spark):
    df = spark.createDataFrame([(20,), (150,), (20,)], "k int")
    assert encode.fit_one_hot(df, ["k"]).output_columns() == ["k_150", "k_20"]


def test_drop_unshared_levels(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "train"), ("a", "test"), ("c", "test")],
                               "c string, _split string")
    m = encode.fit_one_hot(df, ["c"])
    out = encode.drop_unshared_levels(m.transform(df), m)
    assert [c for c in out.columns if c.startswith("c_")] == ["c_a"]
    assert encode.unshared_levels(df, ["c"]).count() == 2


def test_one_hot_sparse_vector_equals_dense(spark):
    df = spark.createDataFrame([(1, "b", 3), (2, "a", None), (3, None, 3), (4, "c", 1)],
                               "id int, s string, n int")
    m = encode.fit_one_hot(df, ["s", "n"])
    dense = {r[0]: list(r[1:]) for r in m.transform(df).orderBy("id").collect()}
    vec = {r.id: list(r.onehot.toArray()) for r in m.to_vector(df).collect()}
    assert len(vec[1]) == len(m.output_columns())
    assert all(vec[i] == [float(x) for x in dense[i]] for i in dense)


def test_level_dictionary_equals_dense(spark):
    df = spark.createDataFrame([(1, "b", 3), (2, "a", None), (3, None, 3), (4, "c", 1), (5, "b", 20)],
                               "id int, s string, n int")
    dense = encode.fit_one_hot(df, ["s", "n"])
    want = {r[0]: list(r[1:]) for r in dense.transform(df).collect()}
    model = encode.fit_level_dictionary(df, ["s", "n"])
    got = {r.id: list(r.onehot.toArray()) for r in model.to_vector(df).collect()}
    assert got == want and model.sizes == {"s": 3, "n": 3}
    unseen = spark.createDataFrame([(9, "z", None)], "id int, s string, n int")
    assert list(model.to_vector(unseen).first().onehot.toArray()) == [0.0] * 6
    empty = encode.fit_level_dictionary(df.where("id > 9"), ["s", "n"])
    assert empty.sizes == {"s": 0, "n": 0}
    assert empty.index(df, {"s": "i"}).where("i is not null").count() == 0


def test_level_dictionary_of_a_million_levels(spark):
    # a third of the rows has one level, ids are dense and follow the order of the levels
    n = 1_000_000
    df = spark.range(3 * n // 2, numPartitions=8).select(
        "id", F.when(F.col("id") < n, F.format_string("L%07d", "id")).otherwise("L0000005").alias("s"))
    model = encode.fit_level_dictionary(df, ["s"])
    assert model.sizes == {"s": n}
    wrong = model.levels.where(F.substring("level", 2, 7).cast("long") != F.col("id")).count()
    assert wrong == 0 and model.levels.count() == n
    vec = model.to_vector(df.where("id % 100000 = 7 or id >= 1499999"))
    rows = {r.id: r.onehot for r in vec.collect()}
    assert len(rows) == 16 and all(v.size == n and v.numNonzeros() == 1 for v in rows.values())
    assert rows[100007].indices[0] == 100007 and rows[1499999].indices[0] == 5
