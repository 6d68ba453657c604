"""The reference's house-price feature pipeline, expressed with tabforge operators.

Input: ``train`` (``Id``, 79 raw features, ``SalePrice``) and ``test`` (same
without the label), e.g. read with ``sources.read_csv(..., null_value="NA")``.
Output: one keyed, split-tagged feature frame plus its ``ColumnPlan``, ready
for ``models.ensemble.fit_ensemble``.

Differences from the reference, by design (see the README):

* rows are keyed by ``Id``: outlier drops and cell patches take ``Id`` values
  (the reference used row positions that no longer match its own data);
* statistics are fitted on train+test like the reference (``fit_on="all"``)
  or on the training rows only (``fit_on="train"``);
* a pair of conditions with neither ``Feedr`` nor ``Artery`` keeps the smaller
  level instead of an arbitrary one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.operators import clean, derive, encode, frame, impute, stats
from tabforge.operators.knn import knn_impute
from tabforge.operators.quantiles import quantiles
from tabforge.operators.transform import fit_skew_fix
from tabforge.plans.column_plan import ColumnPlan
from tabforge.session import checkpoint

KEY, LABEL = "Id", "SalePrice"

# The reference's lookup tables, level lists and column lists.
NONE_VALUE = "None"
QUALITIES = {NONE_VALUE: 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
FIN_QUALITIES = {NONE_VALUE: 0, "Unf": 1, "LwQ": 2, "Rec": 3, "BLQ": 4, "ALQ": 5, "GLQ": 6}
HOUSE_STYLE = {"1.5Unf": 0, "SFoyer": 1, "1.5Fin": 2, "2.5Unf": 3, "SLvl": 4, "1Story": 5,
               "2Story": 6, "2.5Fin": 7}
MAS_VNR_TYPE = {NONE_VALUE: 0, "Stone": 1, "BrkFace": 2, "BrkCmn": 3}
FOUNDATION = {"BrkTil": 5, "CBlock": 4, "PConc": 3, "Slab": 2, "Stone": 1, "Wood": 0}
BSMT_EXPOSURE = {NONE_VALUE: 0, "No": 0, "Mn": 2, "Av": 3, "Gd": 4}
FUNCTIONAL = {NONE_VALUE: 0, "Sal": 1, "Sev": 2, "Maj2": 3, "Maj1": 4, "Mod": 5, "Min2": 6,
              "Min1": 7, "Typ": 8}
GARAGE_FINISH = {NONE_VALUE: 0, "Unf": 1, "RFn": 2, "Fin": 3}
POOL_QC = {NONE_VALUE: 0, "Fa": 1, "TA": 2, "Gd": 3, "Ex": 4}
FENCE = {NONE_VALUE: 0, "MnWw": 1, "GdWo": 2, "MnPrv": 3, "GdPrv": 4}
SALE_TYPE = {"WD": 9, "CWD": 8, "VWD": 7, "New": 6, "COD": 5, "Con": 4, "ConLw": 3, "ConLI": 2,
             "ConLD": 1, "Oth": 0}
GOOD_NEIGHBORHOODS = ("NridgHt", "Crawfor", "StoneBr", "Somerst", "NoRidge")
EXTERIOR_TYPOS = {"CmentBd": "CemntBd", "Wd Shng": "Wd Sdng", "Brk Cmn": "BrkComm"}
QUALITY_BINS = [(1, 4, 1), (4, 7, 2), (7, 11, 3)]
AREA_COLUMNS = ["LotFrontage", "LotArea", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF",
                "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "GrLivArea", "GarageArea", "WoodDeckSF",
                "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "LowQualFinSF",
                "PoolArea"]
BATHROOM_WEIGHTS = {"FullBath": 1.0, "HalfBath": 0.5, "BsmtFullBath": 1.0, "BsmtHalfBath": 0.5}
ONE_HOT = ["MSZoning", "MSSubClass", "LotShape", "LandContour", "LotConfig", "LandSlope",
           "Neighborhood", "Condition", "Condition1", "Condition2", "BldgType", "HouseStyle",
           "RoofMatl", "Exterior1st", "Exterior2nd", "MasVnrType", "BsmtFinType1", "BsmtFinType2",
           "Heating", "Electrical", "Functional", "GarageType", "PavedDrive", "MiscFeature",
           "MiscVal", "SaleCondition"]
NUMERIC = ["LotFrontage", "LotArea", "HouseStyle_int", "OverallQualSimplified", "OverallQual",
           "OverallCondSimplified", "OverallCond", "YearBuiltBinned", "YearsSinceRemodel",
           "YearRemodAdd", "YrSold", "YearBuilt", "MasVnrArea", "MasVnrType_int", "ExterQual",
           "ExterCond", "Foundation_int", "BsmtQual", "BsmtCond", "BsmtQualCond", "BsmtExposure",
           "BsmtFinType1_int", "BsmtFinSF1", "BsmtFinType2_int", "BsmtFinSF2", "BsmtUnfSF",
           "TotalBsmtSF", "HeatingQC", "1stFlrSF", "2ndFlrSF", "LowQualFinSF", "GrLivArea",
           "BsmtFullBath", "BsmtHalfBath", "FullBath", "HalfBath", "BedroomAbvGr", "KitchenAbvGr",
           "KitchenQual", "TotRmsAbvGrd", "Functional_int", "Fireplaces", "FireplaceQu",
           "GarageYrBlt", "GarageFinish", "GarageCars", "GarageArea", "GarageQual", "GarageCond",
           "WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "PoolArea",
           "PoolQC", "Fence", "MiscVal_int", "MoSold", "SaleType"]
BOOLEAN = ["HasAlley", "IsGoodNeighborhood", "IsRemodeled", "IsRemodelRecent", "IsNewHouse",
           "IsBsmtFinType1Unf", "IsBsmtFinType2Unf", "BsmtIsPresent", "CentralAir",
           "2ndFloorIsPresent", "FireplaceIsPresent", "GarageIsPresent", "HasWoodDeck",
           "HasOpenPorch", "HasEnclosedPorch", "Has3SsnPorch", "HasScreenPorch", "PoolIsPresent",
           "HasShed"]
DROP = ["Street", "Alley", "Utilities", "Condition1", "Condition2", "RoofStyle", "LotShape",
        "LotConfig", "LandSlope", "MasVnrType_int", "Foundation"]
OVERFIT_DUMMIES = ["HouseStyle_2.5Fin", "RoofMatl_Roll", "RoofMatl_Metal", "RoofMatl_Membran",
                   "Heating_Floor", "Heating_OthW", "Electrical_Mix", "MSSubClass_150",
                   "MSSubClass_90", "MSZoning_C (all)"]


@dataclass
class HouseResult:
    frame: DataFrame          # Id, _split, SalePrice (train only), features
    plan: ColumnPlan
    features: list[str]
    skew_lambdas: dict[str, float]
    correlated: DataFrame     # feature pairs with |r| > 0.75 on the final matrix
    nulls: DataFrame          # remaining NULLs per feature (empty after imputation)


def column_plan() -> ColumnPlan:
    plan = ColumnPlan(key=KEY, label=LABEL)
    plan.add("one_hot", *ONE_HOT).add("numeric", *NUMERIC).add("boolean", *BOOLEAN)
    plan.add("drop", *DROP).add("drop_dummies", *OVERFIT_DUMMIES)
    return plan


def clean_train(train: DataFrame, drop_ids: Sequence[int] = ()) -> DataFrame:
    """Outlier removal: listed Ids, then the two conjunctive value filters."""
    out = clean.drop_keys(train, list(drop_ids), KEY) if drop_ids else train
    out = clean.drop_where(out, F.col("OverallQual") < 5, F.col(LABEL) > 200000)
    return clean.drop_where(out, F.col("GrLivArea") > 4000, F.col(LABEL) < 300000)


def derive_features(df: DataFrame, fit_on: DataFrame | None = None,
                    patches: Sequence[tuple] = (), median_patches: Sequence[tuple] = ()) -> DataFrame:
    """Every per-feature step of the reference, in its order.

    ``patches`` are ``(Id, column, value)`` cell writes; ``median_patches`` are
    ``(Id, column)`` cells set to the column's median.
    """
    src = fit_on if fit_on is not None else df
    df = impute.fill_group(df, "MSZoning", "MSSubClass", stat="mode", fit_on=src)
    df = impute.fill_group(df, "LotFrontage", "Neighborhood", stat="median", fit_on=src)
    df = clean.replace_values(df, EXTERIOR_TYPOS, ["Exterior1st", "Exterior2nd"])
    # cell writes come before anything is derived from the cells
    if patches:
        df = clean.patch_cells(df, list(patches), KEY)
    fitted_bins = encode.fit_equal_width(src, "YearBuilt", 7)
    df = df.withColumns({
        "HasAlley": derive.present("Alley"),
        "IsGoodNeighborhood": derive.member("Neighborhood", GOOD_NEIGHBORHOODS),
        "Condition": derive.merge_levels("Condition1", "Condition2", "Norm", ["Feedr", "Artery"]),
        "HouseStyle_int": encode.ordinal("HouseStyle", HOUSE_STYLE),
        "OverallQualSimplified": encode.range_bins("OverallQual", QUALITY_BINS),
        "OverallCondSimplified": encode.range_bins("OverallCond", QUALITY_BINS),
        "YearBuiltBinned": fitted_bins.expr(),
        "IsRemodeled": derive.columns_differ("YearRemodAdd", "YearBuilt"),
        "IsRemodelRecent": derive.columns_equal("YearRemodAdd", "YrSold"),
        "YearsSinceRemodel": derive.difference("YrSold", "YearRemodAdd"),
        "IsNewHouse": derive.columns_equal("YearBuilt", "YrSold"),
        "MasVnrType_int": encode.ordinal("MasVnrType", MAS_VNR_TYPE),
        "Foundation_int": encode.ordinal("Foundation", FOUNDATION),
        "BsmtFinType1_int": encode.ordinal("BsmtFinType1", FIN_QUALITIES),
        "IsBsmtFinType1Unf": derive.equals("BsmtFinType1", "Unf"),
        "BsmtFinType2_int": encode.ordinal("BsmtFinType2", FIN_QUALITIES),
        "IsBsmtFinType2Unf": derive.equals("BsmtFinType2", "Unf"),
        "BsmtIsPresent": derive.positive("TotalBsmtSF"),
        "CentralAir": derive.equals("CentralAir", "Y"),
        "2ndFloorIsPresent": derive.positive("2ndFlrSF"),
        "Functional_int": encode.ordinal("Functional", FUNCTIONAL),
        "FireplaceIsPresent": derive.positive("Fireplaces"),
        "HasWoodDeck": derive.zero("WoodDeckSF"),
        "HasOpenPorch": derive.zero("OpenPorchSF"),
        "HasEnclosedPorch": derive.zero("EnclosedPorch"),
        "Has3SsnPorch": derive.zero("3SsnPorch"),
        "HasScreenPorch": derive.zero("ScreenPorch"),
        "PoolIsPresent": derive.positive("PoolArea"),
        "MiscVal_int": qcol("MiscVal"),
        "HasShed": derive.all_of(F.col("MiscFeature") == "Shed", F.col("MiscVal") > 0),
    })
    df = df.withColumns({c: encode.ordinal(c, QUALITIES) for c in
                         ("ExterQual", "ExterCond", "BsmtQual", "BsmtCond", "HeatingQC",
                          "KitchenQual", "FireplaceQu", "GarageQual", "GarageCond")})
    df = df.withColumns({
        "ExterQualCond": derive.mean_of("ExterQual", "ExterCond"),
        "BsmtQualCond": derive.mean_of("BsmtQual", "BsmtCond"),
        "BsmtExposure": encode.ordinal("BsmtExposure", BSMT_EXPOSURE),
        "GarageFinish": encode.ordinal("GarageFinish", GARAGE_FINISH),
        "GarageQualCond": derive.mean_of("GarageCond", "GarageQual"),
        "PoolQC": encode.ordinal("PoolQC", POOL_QC),
        "Fence": encode.ordinal("Fence", FENCE),
        "SaleType": encode.ordinal("SaleType", SALE_TYPE),
    })
    if median_patches:
        cols = sorted({c for _, c in median_patches})
        med = {c: quantiles(src, c, [0.5], names=["m"]).first()["m"] for c in cols}
        df = clean.patch_cells(df, [(k, c, med[c]) for k, c in median_patches], KEY)
    return df.withColumn("GarageIsPresent", derive.positive("GarageYrBlt"))


def engineer(train: DataFrame, test: DataFrame, drop_ids: Sequence[int] = (),
             patches: Sequence[tuple] = (), median_patches: Sequence[tuple] = (),
             fit_on: str = "all", overfit_dummies: Sequence[str] | str | None = None,
             knn_k: int = 10, skew_threshold: float = 0.5) -> HouseResult:
    """Whole feature pipeline.

    ``overfit_dummies=None`` drops the reference's ten dummies (each must exist),
    a list drops those, ``[]`` keeps every dummy, and ``"auto"`` drops the
    dummies of every level seen in only one split (``encode.drop_unshared_levels``).
    """
    plan = column_plan()
    raw_columns = [c for c in train.columns if c not in (KEY, LABEL)]
    both = frame.union_tagged(clean_train(train, drop_ids), test)
    fit_src = both.where(F.col("_split") == "train") if fit_on == "train" else both
    df = derive_features(both, fit_on=fit_src, patches=patches, median_patches=median_patches)

    # totals on the values before any imputation (the reference keeps a copy)
    df = df.withColumns({"TotalArea": derive.row_sum(AREA_COLUMNS),
                         "Total_Bathrooms": derive.weighted_sum(BATHROOM_WEIGHTS)})
    plan.validate(df, raw_columns=raw_columns)
    p = plan.pruned()
    df = df.drop(*p.drop)

    def fitted(rows):
        return rows.where(F.col("_split") == "train") if fit_on == "train" else rows

    mode = impute.fit_mode_imputer(fitted(df), p.one_hot)
    df = mode.transform(df)
    onehot = encode.fit_one_hot(fitted(df), p.one_hot)
    df = onehot.transform(df)
    if overfit_dummies == "auto":
        df = encode.drop_unshared_levels(df, onehot)
    else:
        drops = OVERFIT_DUMMIES if overfit_dummies is None else list(overfit_dummies)
        df = encode.drop_unshared_levels(df, onehot, names=drops)
    features = [c for c in df.columns if c not in (KEY, LABEL, "_split")]

    # KNN over the matrix without the two totals, then once more with them: the
    # second pass fills the bathroom total, which propagated NULLs
    df = checkpoint(df)
    first = [c for c in features if c not in ("TotalArea", "Total_Bathrooms")]
    for cols in (first, features):
        nulls = [r.feature for r in stats.null_report(df, cols).collect()]
        if nulls:
            donors = F.col("_split") == "train" if fit_on == "train" else None
            df = checkpoint(knn_impute(df, KEY, cols, targets=nulls, k=knn_k, donors=donors))

    numeric = [c for c in p.numeric if c in df.columns] + ["TotalArea", "Total_Bathrooms"]
    skew = fit_skew_fix(fitted(df), numeric, threshold=skew_threshold)
    df = skew.transform(df)
    out = checkpoint(df.select(*[qcol(c) for c in (KEY, "_split", LABEL, *features)]))
    # the reference's closing reports: correlated pairs (one XᵀX pass) and missing values
    correlated = stats.correlated_pairs(out, features, 0.75, complete_rows=True)
    return HouseResult(out, p, features, skew.lambdas, correlated, stats.null_report(out, features))
