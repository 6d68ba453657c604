import tempfile

from pyspark.sql import functions as F

from conftest import SF
from tabforge.models.linear import fit_ridge
from tabforge.operators import encode, impute
from tabforge.streaming import apply_steps, score_stream


def test_fitted_steps_score_a_stream(spark):
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    onehot = encode.fit_one_hot(cust, ["c_mktsegment"])
    mode = impute.fit_mode_imputer(cust, ["c_mktsegment"])
    feats = onehot.output_columns() + ["c_nationkey"]
    model = fit_ridge(onehot.transform(cust), feats, "c_acctbal", alpha=1.0)
    steps = [mode.transform, onehot.transform, lambda df: model.transform(df, "pred")]

    batch = apply_steps(cust, steps).select("c_custkey", "pred")
    stream = (spark.readStream.schema(cust.schema).option("pathGlobFilter", "customer.parquet")
              .parquet(SF))
    out, ckpt = tempfile.mkdtemp(), tempfile.mkdtemp()
    q = score_stream(stream, steps, out, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out).select("c_custkey", "pred")
    assert got.count() == cust.count()
    assert got.exceptAll(batch).count() == 0
