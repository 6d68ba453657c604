from pyspark.sql import functions as F

from house_fixture import house_tables
from tabforge.plans import house


def test_house_pipeline(spark):
    train, test = house_tables(spark)
    assert len(train.columns) == 81
    res = house.engineer(train, test, drop_ids=[31], patches=[(334, "BsmtFinType2", "ALQ")],
                         median_patches=[(10, "GarageCars"), (10, "GarageArea")])
    df = res.frame
    p = res.plan
    assert len(p.one_hot) == 21 and len(p.boolean) == 19 and len(p.numeric) == 59
    for c in house.OVERFIT_DUMMIES:
        assert c not in df.columns
    assert "MSZoning_RL" in df.columns and "Condition_Norm" in df.columns
    counts = {r["_split"]: r["count"] for r in df.groupBy("_split").count().collect()}
    assert counts["test"] == 200 and counts["train"] < 200
    assert 31 not in [r.Id for r in df.where(F.col("_split") == "train").select("Id").collect()]
    nulls = df.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(str(i))
                        for i, c in enumerate(res.features)]).first()
    assert sum(nulls) == 0
    assert "LotArea" in res.skew_lambdas
    assert res.nulls.count() == 0
    pairs = res.correlated.collect()
    assert all(abs(r.r) > 0.75 and r.a < r.b for r in pairs)
