import tempfile

from house_fixture import house_tables
from tabforge.sources.tables import read_csv, write_csv, write_predictions


def test_house_tables_roundtrip_through_na_csv(spark):
    train, _ = house_tables(spark, n_train=60, n_test=10)
    path = tempfile.mkdtemp(prefix="house-csv-")
    write_csv(train, path)
    back = read_csv(spark, path, train.schema)
    assert back.count() == train.count()
    assert back.exceptAll(train).count() == 0 and train.exceptAll(back).count() == 0
    raw = spark.read.text(path)
    assert raw.where(raw.value.contains(",NA,")).count() > 0        # NULL written as NA


def test_prediction_sink_writes_key_and_prediction_only(spark):
    df = spark.createDataFrame([(1461, 120000, 3.0), (1462, 98000, 1.0)], "Id int, SalePrice int, x double")
    path = tempfile.mkdtemp(prefix="preds-")
    write_predictions(df, path, "Id", "SalePrice")
    back = read_csv(spark, path, "Id int, SalePrice int")
    assert sorted(map(tuple, back.collect())) == [(1461, 120000), (1462, 98000)]
