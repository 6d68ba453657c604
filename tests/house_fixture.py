"""Synthetic house-sales tables with the reference's input schema (FIXTURES.md §1).

200 train + 200 test rows, seed 42, about 5 % NULL in every nullable column,
every level of every categorical at least once, three levels only in train.
"""

import numpy as np

CATEGORICAL = {
    "MSZoning": ["A", "C (all)", "FV", "I", "RH", "RL", "RP", "RM"],
    "Street": ["Grvl", "Pave"], "Alley": ["Grvl", "Pave"],
    "LotShape": ["Reg", "IR1", "IR2", "IR3"], "LandContour": ["Lvl", "Bnk", "HLS", "Low"],
    "Utilities": ["AllPub", "NoSewr", "NoSeWa", "ELO"],
    "LotConfig": ["Inside", "Corner", "CulDSac", "FR2", "FR3"], "LandSlope": ["Gtl", "Mod", "Sev"],
    "Neighborhood": ["Blmngtn", "Blueste", "BrDale", "BrkSide", "ClearCr", "CollgCr", "Crawfor",
                     "Edwards", "Gilbert", "IDOTRR", "MeadowV", "Mitchel", "Names", "NoRidge",
                     "NPkVill", "NridgHt", "NWAmes", "OldTown", "SWISU", "Sawyer", "SawyerW",
                     "Somerst", "StoneBr", "Timber", "Veenker"],
    "Condition1": ["Artery", "Feedr", "Norm", "RRNn", "RRAn", "PosN", "PosA", "RRNe", "RRAe"],
    "Condition2": ["Artery", "Feedr", "Norm", "RRNn", "RRAn", "PosN", "PosA", "RRNe", "RRAe"],
    "BldgType": ["1Fam", "2fmCon", "Duplex", "TwnhsE", "Twnhs"],
    "HouseStyle": ["1Story", "1.5Fin", "1.5Unf", "2Story", "2.5Fin", "2.5Unf", "SFoyer", "SLvl"],
    "RoofStyle": ["Flat", "Gable", "Gambrel", "Hip", "Mansard", "Shed"],
    "RoofMatl": ["ClyTile", "CompShg", "Membran", "Metal", "Roll", "Tar&Grv", "WdShake", "WdShngl"],
    "Exterior1st": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing", "CmentBd"],
    "Exterior2nd": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing", "Wd Shng", "Brk Cmn"],
    "MasVnrType": ["BrkCmn", "BrkFace", "CBlock", "None", "Stone"],
    "ExterQual": ["Ex", "Gd", "TA", "Fa", "Po"], "ExterCond": ["Ex", "Gd", "TA", "Fa", "Po"],
    "Foundation": ["BrkTil", "CBlock", "PConc", "Slab", "Stone", "Wood"],
    "BsmtQual": ["Ex", "Gd", "TA", "Fa", "Po"], "BsmtCond": ["Ex", "Gd", "TA", "Fa", "Po"],
    "BsmtExposure": ["Gd", "Av", "Mn", "No"],
    "BsmtFinType1": ["GLQ", "ALQ", "BLQ", "Rec", "LwQ", "Unf"],
    "BsmtFinType2": ["GLQ", "ALQ", "BLQ", "Rec", "LwQ", "Unf"],
    "Heating": ["Floor", "GasA", "GasW", "Grav", "OthW", "Wall"],
    "HeatingQC": ["Ex", "Gd", "TA", "Fa", "Po"], "CentralAir": ["N", "Y"],
    "Electrical": ["SBrkr", "FuseA", "FuseF", "FuseP", "Mix"],
    "KitchenQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "Functional": ["Typ", "Min1", "Min2", "Mod", "Maj1", "Maj2", "Sev", "Sal"],
    "FireplaceQu": ["Ex", "Gd", "TA", "Fa", "Po"],
    "GarageType": ["2Types", "Attchd", "Basment", "BuiltIn", "CarPort", "Detchd"],
    "GarageFinish": ["Fin", "RFn", "Unf"], "GarageQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "GarageCond": ["Ex", "Gd", "TA", "Fa", "Po"], "PavedDrive": ["Y", "P", "N"],
    "PoolQC": ["Ex", "Gd", "TA", "Fa"], "Fence": ["GdPrv", "MnPrv", "GdWo", "MnWw"],
    "MiscFeature": ["Elev", "Gar2", "Othr", "Shed", "TenC"],
    "SaleType": ["WD", "CWD", "VWD", "New", "COD", "Con", "ConLw", "ConLI", "ConLD", "Oth"],
    "SaleCondition": ["Normal", "Abnorml", "AdjLand", "Alloca", "Family", "Partial"],
}
# (name, type, low, high)
NUMERIC = [
    ("MSSubClass", "int", None, None), ("LotFrontage", "double", 21, 313), ("LotArea", "int", 1300, 215000),
    ("OverallQual", "int", 1, 10), ("OverallCond", "int", 1, 10), ("YearBuilt", "int", 1872, 2010),
    ("YearRemodAdd", "int", 1950, 2010), ("MasVnrArea", "double", 0, 1600),
    ("BsmtFinSF1", "double", 0, 5600), ("BsmtFinSF2", "double", 0, 1500), ("BsmtUnfSF", "double", 0, 2300),
    ("TotalBsmtSF", "double", 0, 6100), ("1stFlrSF", "int", 330, 4700), ("2ndFlrSF", "int", 0, 2000),
    ("LowQualFinSF", "int", 0, 570), ("GrLivArea", "int", 330, 3900), ("BsmtFullBath", "double", 0, 3),
    ("BsmtHalfBath", "double", 0, 2), ("FullBath", "int", 0, 3), ("HalfBath", "int", 0, 2),
    ("BedroomAbvGr", "int", 0, 8), ("KitchenAbvGr", "int", 0, 3), ("TotRmsAbvGrd", "int", 2, 14),
    ("Fireplaces", "int", 0, 3), ("GarageYrBlt", "double", 1900, 2010), ("GarageCars", "double", 0, 4),
    ("GarageArea", "double", 0, 1400), ("WoodDeckSF", "int", 0, 860), ("OpenPorchSF", "int", 0, 540),
    ("EnclosedPorch", "int", 0, 550), ("3SsnPorch", "int", 0, 500), ("ScreenPorch", "int", 0, 480),
    ("PoolArea", "int", 0, 740), ("MiscVal", "int", None, None), ("MoSold", "int", 1, 12),
    ("YrSold", "int", 2006, 2010),
]
MSSUBCLASS = [20, 30, 40, 45, 50, 60, 70, 75, 80, 85, 90, 120, 150, 160, 180, 190]
NOT_NULL = {"Id", "SalePrice", "OverallQual", "GrLivArea", "YearBuilt", "YrSold", "MSSubClass",
            "Neighborhood", "Condition1", "Condition2", "HouseStyle", "RoofMatl", "Heating",
            "Electrical"}
TRAIN_ONLY = {"HouseStyle": "2.5Fin", "RoofMatl": "Roll", "Heating": "Floor"}


def house_tables(spark, n_train=200, n_test=200, seed=42):
    rng = np.random.default_rng(seed)
    n = n_train + n_test
    cols = {"Id": list(range(1, n + 1))}
    order = ["Id"]
    for name, typ, lo, hi in NUMERIC:
        if name == "MSSubClass":
            v = [MSSUBCLASS[i % len(MSSUBCLASS)] for i in range(n)]
        elif name == "MiscVal":
            v = [int(x) for x in rng.choice([0, 0, 0, 400, 500, 700, 2000], n)]
        elif name == "LotArea":
            v = [int(x) for x in rng.lognormal(9.0, 0.6, n)]
        elif typ == "int":
            v = [int(x) for x in rng.integers(lo, hi + 1, n)]
        else:
            v = [float(round(x, 0)) for x in rng.uniform(lo, hi, n)]
        cols[name] = v
        order.append(name)
    for name, levels in CATEGORICAL.items():
        pool = [lv for lv in levels if TRAIN_ONLY.get(name) != lv]
        v = [pool[int(i)] for i in rng.integers(0, len(pool), n)]
        for i, lv in enumerate(pool):         # every level at least once
            v[(i * 7 + 3) % n] = lv
        if name in TRAIN_ONLY:
            v[5] = TRAIN_ONLY[name]           # row 5 is in train
        cols[name] = v
        order.append(name)
    for name in order:
        if name in NOT_NULL:
            continue
        mask = rng.random(n) < 0.05
        cols[name] = [None if m else x for x, m in zip(cols[name], mask)]
    qual = np.array(cols["OverallQual"], dtype=float)
    area = np.array(cols["GrLivArea"], dtype=float)
    price = np.exp(10.5 + 0.1 * qual + 0.0004 * area + rng.normal(0, 0.1, n))
    cols["SalePrice"] = [int(p) for p in price]
    from pyspark.sql import types as T
    types = {"int": T.IntegerType(), "double": T.DoubleType()}
    fields = [T.StructField("Id", T.IntegerType())]
    fields += [T.StructField(nm, types[tp]) for nm, tp, _, _ in NUMERIC]
    fields += [T.StructField(nm, T.StringType()) for nm in CATEGORICAL]
    schema = T.StructType(fields + [T.StructField("SalePrice", T.IntegerType())])
    names = [f.name for f in schema.fields]
    rows = [tuple(cols[c][i] for c in names) for i in range(n)]
    df = spark.createDataFrame(rows, schema)
    train = df.where(df.Id <= n_train)
    test = df.where(df.Id > n_train).drop("SalePrice")
    return train, test
