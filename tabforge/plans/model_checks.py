"""Queries of the model layer at settings that SQL can follow, with their DuckDB statements.

The full-size model queries are in ``queries``; those here run the same functions over the whole
order table with one or two features, ``mod`` folds, single stumps and fixed lambda grids, where
closed forms or short recursions give the answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions import normal
from tabforge.operators import folds, frame
from tabforge.operators.quantiles import unpivot, value_ranks
from tabforge.plans.queries import AGG_COLS, ORDER_AGGS, order_aggs, r4, r6, register, t

FEATS = ["n_lines", "sum_qty"]
ROWS = f"""{ORDER_AGGS},
rows_ AS (SELECT l_orderkey, l_orderkey % 5 AS fold, CAST(n_lines AS DOUBLE) AS x1,
                 CAST(sum_qty AS DOUBLE) AS x2, ln(1 + sum_price) AS y FROM order_aggs)"""


def _rows(spark, d):
    return order_aggs(spark, d).select("l_orderkey", (F.col("l_orderkey") % 5).cast("int").alias("fold"),
                                       *FEATS, F.log1p("sum_price").alias("y"))


# ----------------------------------------------------------------------------- P2, P7, P13, K2

@register("project_shape", """
SELECT c_custkey, c_acctbal, (SELECT COUNT(*) FROM customer) AS n_rows, CAST(2 AS BIGINT) AS n_columns
FROM customer""")
def q_project_shape(spark, d):
    out = frame.project(t(spark, d, "customer"), ["c_custkey", "c_acctbal"])
    n, m = frame.shape(out)
    return out.select("*", F.lit(n).cast("long").alias("n_rows"), F.lit(m).cast("long").alias("n_columns"))


@register("holdout_mod", """
SELECT CAST((((o_orderkey % 1000003) * 7919 + 7 * 104729) % 1000003 < 500001) AS INTEGER) AS is_holdout,
       COUNT(*) AS rows, ROUND(AVG(o_totalprice), 4) AS avg_price
FROM orders GROUP BY 1""")
def q_holdout_mod(spark, d):
    o = folds.holdout(t(spark, d, "orders", ["o_orderkey", "o_totalprice"]), "o_orderkey", 0.5,
                      seed=7, method="mod")
    return o.groupBy("is_holdout").agg(F.count(F.lit(1)).alias("rows"),
                                       r4(F.avg("o_totalprice")).alias("avg_price"))


# ----------------------------------------------------------------------------- R1, R2, R3, R5

RIDGE_GRID = [4.0, 7.0, 15.49, 1000.0]
ENET_GRID, ENET_RATIOS = [0.0001, 0.01, 0.3, 3.0], [0.1, 0.5, 1.0]
TRAIN = """tr AS (SELECT f.k, COUNT(*) AS n, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my,
    COUNT(*) * VAR_POP(x1) AS g11, COUNT(*) * VAR_POP(x2) AS g22, COUNT(*) * COVAR_POP(x1, x2) AS g12,
    COUNT(*) * COVAR_POP(x1, y) AS c1, COUNT(*) * COVAR_POP(x2, y) AS c2
  FROM rows_ JOIN (SELECT unnest(range(5)) AS k) f ON rows_.fold <> f.k GROUP BY f.k)"""


@register("ridge_cv_two", f"""
WITH {ROWS}, {TRAIN},
w AS (SELECT k, alpha, m1, m2, my,
             ((g22 + alpha) * c1 - g12 * c2) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS w1,
             ((g11 + alpha) * c2 - g12 * c1) / ((g11 + alpha) * (g22 + alpha) - g12 * g12) AS w2
      FROM tr, (SELECT unnest({RIDGE_GRID}) AS alpha)),
s AS (SELECT alpha, k, 1 - SUM(POWER(y - my - w1 * (x1 - m1) - w2 * (x2 - m2), 2))
                         / (COUNT(*) * VAR_POP(y)) AS r2
      FROM rows_ JOIN w ON rows_.fold = w.k GROUP BY alpha, k),
a AS (SELECT alpha, AVG(r2) AS r2 FROM s GROUP BY alpha)
SELECT CAST(alpha AS DOUBLE) AS alpha, ROUND(r2, 6) AS cv_r2, r2 = (SELECT MAX(r2) FROM a) AS best FROM a""")
def q_ridge_cv_two(spark, d):
    from tabforge.models.gram import gram_stats
    from tabforge.models.linear import ridge_cv
    best, scores = ridge_cv(gram_stats(_rows(spark, d), FEATS, "y", "fold"), RIDGE_GRID)
    return spark.createDataFrame([(a, round(s, 6), a == best) for a, s in zip(RIDGE_GRID, scores)],
                                 "alpha double, cv_r2 double, best boolean")


def _enet_sql(ratios) -> str:
    return f"""
WITH {ROWS}, {TRAIN},
w AS (SELECT k, alpha, rho, m2, my,
             SIGN(c2) * GREATEST(ABS(c2) - n * alpha * rho, 0) / (g22 + n * alpha * (1 - rho)) AS w
      FROM tr, (SELECT unnest({ENET_GRID}) AS alpha), (SELECT unnest({ratios}) AS rho)),
s AS (SELECT alpha, rho, k, AVG(POWER(y - my - w * (x2 - m2), 2)) AS mse
      FROM rows_ JOIN w ON rows_.fold = w.k GROUP BY alpha, rho, k),
a AS (SELECT alpha, rho, AVG(mse) AS mse FROM s GROUP BY alpha, rho)
SELECT CAST(alpha AS DOUBLE) AS alpha, CAST(rho AS DOUBLE) AS l1_ratio, ROUND(mse, 6) AS cv_mse,
       mse = (SELECT MIN(mse) FROM a) AS best FROM a"""


def _enet_scores(spark, d, ratios):
    from tabforge.models.gram import gram_stats
    from tabforge.models.linear import enet_cv
    a, r, scores = enet_cv(gram_stats(_rows(spark, d), ["sum_qty"], "y", "fold"), ENET_GRID, ratios)
    return spark.createDataFrame(
        [(x, rho, round(float(scores[i, j]), 6), (x, rho) == (a, r))
         for i, rho in enumerate(ratios) for j, x in enumerate(ENET_GRID)],
        "alpha double, l1_ratio double, cv_mse double, best boolean")


@register("lasso_cv_one", _enet_sql([1.0]))
def q_lasso_cv_one(spark, d):
    return _enet_scores(spark, d, [1.0])


@register("enet_cv_one", _enet_sql(ENET_RATIOS))
def q_enet_cv_one(spark, d):
    return _enet_scores(spark, d, ENET_RATIOS)


@register("bayes_ridge_one", f"""
WITH RECURSIVE {ROWS},
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(x2) AS mx, AVG(y) AS my, COUNT(*) * VAR_POP(x2) AS g,
             COUNT(*) * COVAR_POP(x2, y) AS c, COUNT(*) * VAR_POP(y) AS yy FROM rows_),
it(k, w, prev, noise, weight, done) AS (
  SELECT 0, c / (g + yy / n), CAST(NULL AS DOUBLE), n / yy, CAST(1 AS DOUBLE), FALSE FROM s
  UNION ALL
  SELECT k + 1, c / (g + wt / ns), w, ns, wt, COALESCE(ABS(w - prev) < 1e-3, FALSE)
  FROM (SELECT *, (n - det + 2e-6) / (yy - 2 * w * c + w * w * g + 2e-6) AS ns,
               (det + 2e-6) / (w * w + 2e-6) AS wt
        FROM (SELECT it.*, s.*, noise * g / (weight + noise * g) AS det FROM it, s
              WHERE NOT done AND k < 10000))),
z AS (SELECT it.*, s.mx, s.my FROM it, s WHERE done)
SELECT 'intercept' AS term, ROUND(my - w * mx, 6) AS value FROM z
UNION ALL SELECT 'sum_qty', ROUND(w, 6) FROM z
UNION ALL SELECT 'noise', ROUND(noise, 6) FROM z
UNION ALL SELECT 'weight', ROUND(ln(weight), 6) FROM z""")
def q_bayes_ridge_one(spark, d):
    import math

    from tabforge.models.linear import fit_bayes_ridge
    m = fit_bayes_ridge(_rows(spark, d), ["sum_qty"], "y")
    return spark.createDataFrame(
        [("intercept", round(m.intercept, 6)), ("sum_qty", round(float(m.coef[0]), 6)),
         ("noise", round(m.params["alpha_"], 6)), ("weight", round(math.log(m.params["lambda_"]), 6))],
        "term string, value double")


# ----------------------------------------------------------------------------- R4

def _stump_sql(target: str) -> str:
    """Best split ``x1 <= cut`` of ``target`` over ``r_`` with at least 15 rows a side."""
    return f"""cuts AS (SELECT DISTINCT x1 AS cut FROM r_),
gain AS (SELECT cut, POWER(SUM({target}) FILTER (x1 <= cut), 2) / COUNT(*) FILTER (x1 <= cut)
                   + POWER(SUM({target}) FILTER (x1 > cut), 2) / COUNT(*) FILTER (x1 > cut) AS g
         FROM r_, cuts GROUP BY cut
         HAVING COUNT(*) FILTER (x1 <= cut) >= 15 AND COUNT(*) FILTER (x1 > cut) >= 15),
leafed AS (SELECT r_.*, x1 <= (SELECT arg_max(cut, g) FROM gain) AS leaf FROM r_)"""


@register("gbt_stump", f"""
WITH {ROWS}, r_ AS (SELECT * FROM rows_), {_stump_sql('y')},
v AS (SELECT leaf, AVG(y) AS p FROM leafed GROUP BY leaf)
SELECT l_orderkey, ROUND(p, 6) AS pred FROM leafed JOIN v USING (leaf)""")
def q_gbt_stump(spark, d):
    from tabforge.models.boost import fit_gbt
    rows = _rows(spark, d)
    m = fit_gbt(rows, ["n_lines"], "y", n_trees=1, max_depth=1, feature_subset="all")
    return m.transform(rows, "pred").select("l_orderkey", r6("pred").alias("pred"))


@register("huber_stump", f"""
WITH {ROWS}, c AS (SELECT quantile_cont(y, 0.5) AS init FROM rows_),
q AS (SELECT rows_.*, init, y - init AS r FROM rows_, c),
dl AS (SELECT quantile_cont(ABS(r), 0.9) AS delta FROM q),
r_ AS (SELECT q.*, delta, CASE WHEN ABS(r) <= delta THEN r ELSE SIGN(r) * delta END AS g FROM q, dl),
{_stump_sql('g')},
md AS (SELECT leaf, quantile_cont(r, 0.5) AS med FROM leafed GROUP BY leaf),
v AS (SELECT leaf, ANY_VALUE(med) + AVG(SIGN(r - med) * LEAST(ABS(r - med), delta)) AS gamma
      FROM leafed JOIN md USING (leaf) GROUP BY leaf)
SELECT l_orderkey, ROUND(init + 0.1 * gamma, 6) AS pred FROM leafed JOIN v USING (leaf)""")
def q_huber_stump(spark, d):
    from tabforge.models.boost import fit_gbt
    rows = _rows(spark, d)
    m = fit_gbt(rows, ["n_lines"], "y", n_trees=1, max_depth=1, learning_rate=0.1,
                feature_subset="all", loss="huber")
    return m.transform(rows, "pred").select("l_orderkey", r6("pred").alias("pred"))


# ----------------------------------------------------------------------------- T1-T4, W2

def _poly_sql(coefs, r: str) -> str:
    acc = f"({coefs[0]!r})"
    for c in coefs[1:]:
        acc = f"({acc} * {r} + ({c!r}))"
    return acc


def _ppf_sql(p: str) -> str:
    """AS 241 over the columns ``q = p - 0.5`` and ``r = sqrt(-ln(min(p, 1 - p)))``."""
    def ratio(num, den, r):
        return f"{_poly_sql(num, r)} / {_poly_sql(den, r)}"
    rc = "(0.180625 - q * q)"
    return (f"CASE WHEN ABS(q) <= 0.425 THEN q * {ratio(normal._CENTRAL_NUM, normal._CENTRAL_DEN, rc)} "
            f"ELSE SIGN(q) * CASE WHEN r <= 5 THEN {ratio(normal._NEAR_NUM, normal._NEAR_DEN, '(r - 1.6)')} "
            f"ELSE {ratio(normal._TAIL_NUM, normal._TAIL_DEN, '(r - 5.0)')} END END")


@register("normal_scores", f"""
WITH {ORDER_AGGS},
l AS (SELECT 'n_lines' AS feature, CAST(n_lines AS DOUBLE) AS x FROM order_aggs
      UNION ALL SELECT 'sum_qty', CAST(sum_qty AS DOUBLE) FROM order_aggs),
i AS (SELECT feature, x, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY x) AS i,
             COUNT(*) OVER (PARTITION BY feature) AS n FROM l),
u AS (SELECT *, CASE WHEN i = n THEN POWER(0.5, 1.0 / n) WHEN i = 1 THEN 1 - POWER(0.5, 1.0 / n)
                     ELSE (i - 0.3175) / (n + 0.365) END AS u FROM i),
q AS (SELECT *, CAST(u AS DOUBLE) - 0.5 AS q, sqrt(-ln(LEAST(u, 1 - u))) AS r FROM u),
z AS (SELECT feature, x, {_ppf_sql('u')} AS z FROM q)
SELECT feature, ROUND(x, 6) AS x, COUNT(*) AS n, ROUND(SUM(z), 5) AS z, ROUND(SUM(z * z), 5) AS zz
FROM z GROUP BY feature, x""")
def q_normal_scores(spark, d):
    from tabforge.operators.transform import normal_score_sums
    long = unpivot(order_aggs(spark, d), FEATS).select("feature", F.col("value").alias("x"))
    s = normal_score_sums(value_ranks(long, "x", by=["feature"]))
    return s.select("feature", r6("x").alias("x"), F.col("_cnt").alias("n"),
                    F.round("z", 5).alias("z"), F.round("zz", 5).alias("zz"))


@register("lambda_grid", f"""
WITH {ORDER_AGGS},
l AS (SELECT 'n_lines' AS feature, n_lines + 1.0::DOUBLE AS x FROM order_aggs
      UNION ALL SELECT 'sum_qty', sum_qty + 1.0::DOUBLE FROM order_aggs),
g AS (SELECT CAST(unnest(range(-20, 21)) / 4.0 AS DOUBLE) AS lam),
a AS (SELECT feature, lam, (lam - 1) * SUM(ln(x)) - COUNT(*) / 2.0 * ln(VAR_POP(
        CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END)) AS llf
      FROM l, g GROUP BY feature, lam)
SELECT feature, arg_max(lam, llf) AS lambda FROM a GROUP BY feature""")
def q_lambda_grid(spark, d):
    from tabforge.operators.transform import fit_lambdas
    fit = fit_lambdas(order_aggs(spark, d), FEATS, method="mle", refinements=0)
    return spark.createDataFrame([(c, round(v, 6)) for c, v in fit.lambdas.items()],
                                 "feature string, lambda double")


SKEW_COLS = AGG_COLS + ["price_sq"]


def _skew_fixed_sql() -> str:
    each = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM o" for c in SKEW_COLS)

    def skew(x):
        return f"AVG(POWER({x} - m_{x}, 3)) / POWER(AVG(POWER({x} - m_{x}, 2)), 1.5)"
    return f"""
WITH {ORDER_AGGS}, o AS (SELECT *, POWER(sum_price / 1000, 2) AS price_sq FROM order_aggs), l AS ({each}),
b AS (SELECT *, (POWER(1 + x, 0.25) - 1) / 0.25 AS t FROM l),
m AS (SELECT *, AVG(x) OVER (PARTITION BY feature) AS m_x, AVG(t) OVER (PARTITION BY feature) AS m_t FROM b),
s AS (SELECT feature, {skew('x')} AS before, {skew('t')} AS after FROM m GROUP BY feature)
SELECT feature, ROUND(before, 5) AS skew_before,
       ROUND(CASE WHEN before > 0.3 THEN after ELSE before END, 5) AS skew_after,
       CASE WHEN before > 0.3 THEN CAST(0.25 AS DOUBLE) END AS lambda FROM s"""


@register("skew_fix_fixed", _skew_fixed_sql())
def q_skew_fix_fixed(spark, d):
    from tabforge.operators.transform import SkewFixModel, select_skewed
    rows = order_aggs(spark, d).withColumn("price_sq", F.pow(F.col("sum_price") / 1000, 2))
    chosen, before = select_skewed(rows, SKEW_COLS, threshold=0.3)
    out = SkewFixModel({c: 0.25 for c in chosen}, before).report(rows, SKEW_COLS)
    return out.select("feature", F.round("skew_before", 5).alias("skew_before"),
                      F.round("skew_after", 5).alias("skew_after"), "lambda")


# ----------------------------------------------------------------------------- R6-R11, J4

def _robust_sql(cols, src: str) -> str:
    return "SELECT " + ", ".join(
        f"quantile_cont({c}, 0.5) AS m_{c}, "
        f"CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1 "
        f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS i_{c}" for c in cols) + f" FROM {src}"


def _stack_sql(per_fold: bool = False) -> str:
    """Ridge base on robust-scaled features out of fold, then cyclic coordinate descent of the
    scaled Lasso over both features and the base's predictions.  ``per_fold`` scales each fold's
    base by the other folds' rows: on unscaled features its penalty is 7 squared IQRs."""
    scaled = "x1, x2" if per_fold else "(x1 - m_x1) / i_x1 AS x1, (x2 - m_x2) / i_x2 AS x2"
    p1, p2 = ("p1", "p2") if per_fold else ("7", "7")
    penalty = """
pen AS (SELECT f.k, 7 * POWER(quantile_cont(x1, 0.75) - quantile_cont(x1, 0.25), 2) AS p1,
               7 * POWER(quantile_cont(x2, 0.75) - quantile_cont(x2, 0.25), 2) AS p2
        FROM rows_ JOIN (SELECT unnest(range(-1, 5)) AS k) f ON rows_.fold <> f.k GROUP BY f.k),""" if per_fold else ""
    cols = ["x1", "x2", "p"]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    stats = ", ".join([f"COUNT(*) * COVAR_POP({a}, {b}) AS g_{a}_{b}" for a, b in pairs]
                      + [f"COUNT(*) * COVAR_POP({a}, y) AS c_{a}, AVG({a}) AS a_{a}" for a in cols])

    def g(a, b):
        return f"g_{a}_{b}" if (a, b) in pairs else f"g_{b}_{a}"

    def step(c, cur):
        rho = f"(c_{c} - " + " - ".join(f"{g(c, o)} * {cur[o]}" for o in cols if o != c) + ")"
        return f"SIGN({rho}) * GREATEST(ABS({rho}) - n * 0.0007, 0) / {g(c, c)}"
    return f"""
WITH RECURSIVE {ROWS}, sc AS ({_robust_sql(['x1', 'x2'], 'rows_')}),
raw AS (SELECT l_orderkey, fold, x1 AS o1, x2 AS o2, {scaled}, y
        FROM rows_, sc),{penalty}
tr AS ({TRAIN.split('AS (', 1)[1].rsplit(')', 1)[0].replace('rows_', 'raw')}),
allr AS (SELECT AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, COUNT(*) * VAR_POP(x1) AS g11,
                COUNT(*) * VAR_POP(x2) AS g22, COUNT(*) * COVAR_POP(x1, x2) AS g12,
                COUNT(*) * COVAR_POP(x1, y) AS c1, COUNT(*) * COVAR_POP(x2, y) AS c2 FROM raw),
w AS (SELECT k, m1, m2, my,
             ((g22 + {p2}) * c1 - g12 * c2) / ((g11 + {p1}) * (g22 + {p2}) - g12 * g12) AS w1,
             ((g11 + {p1}) * c2 - g12 * c1) / ((g11 + {p1}) * (g22 + {p2}) - g12 * g12) AS w2
      FROM (SELECT k, m1, m2, my, g11, g22, g12, c1, c2 FROM tr
            UNION ALL SELECT -1, m1, m2, my, g11, g22, g12, c1, c2 FROM allr)
      {"JOIN pen USING (k)" if per_fold else ""}),
oof AS (SELECT o1, o2, y, my + w1 * (x1 - m1) + w2 * (x2 - m2) AS o3 FROM raw JOIN w ON raw.fold = w.k),
ms AS ({_robust_sql(['o1', 'o2', 'o3'], 'oof')}),
meta AS (SELECT (o1 - m_o1) / i_o1 AS x1, (o2 - m_o2) / i_o2 AS x2, (o3 - m_o3) / i_o3 AS p, y FROM oof, ms),
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(y) AS a_y, {stats} FROM meta),
it(k, w_x1, w_x2, w_p, moved) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT k + 1, n1, n2, n3, GREATEST(ABS(n1 - w_x1), ABS(n2 - w_x2), ABS(n3 - w_p)) FROM (
    SELECT *, {step('p', {'x1': 'n1', 'x2': 'n2'})} AS n3 FROM (
      SELECT *, {step('x2', {'x1': 'n1', 'p': 'w_p'})} AS n2 FROM (
        SELECT *, {step('x1', {'x2': 'w_x2', 'p': 'w_p'})} AS n1 FROM it, s
        WHERE moved > 1e-10 AND k < 20000)))),
z AS (SELECT it.*, s.*, ms.* FROM it, s, ms WHERE k = (SELECT MAX(k) FROM it)),
full_ AS (SELECT l_orderkey, o1, o2, my + w1 * (x1 - m1) + w2 * (x2 - m2) AS o3 FROM raw JOIN w ON w.k = -1)
SELECT l_orderkey, ROUND(a_y + w_x1 * ((o1 - m_o1) / i_o1 - a_x1) + w_x2 * ((o2 - m_o2) / i_o2 - a_x2)
                         + w_p * ((o3 - m_o3) / i_o3 - a_p), 4) AS pred FROM full_, z"""


def _stacked_ridge(spark, d, per_fold: bool):
    from tabforge.models.ensemble import EnsembleConfig, fit_stack
    rows = _rows(spark, d).drop("fold")
    cfg = EnsembleConfig(stack_folds=5, gbt_trees=0, per_fold_scaling=per_fold, fold_method="mod",
                         bases=("ridge",), meta_tol=1e-9)
    m = fit_stack(rows, "l_orderkey", FEATS, "y", cfg)
    return m.transform(rows, "pred").select("l_orderkey", r4("pred").alias("pred"))


@register("stacking_ridge", _stack_sql())
def q_stacking_ridge(spark, d):
    return _stacked_ridge(spark, d, False)


@register("stacking_ridge_scaled", _stack_sql(per_fold=True))
def q_stacking_ridge_scaled(spark, d):
    return _stacked_ridge(spark, d, True)


@register("fold_scalers", f"""
WITH {ROWS}, f AS (SELECT unnest(range(5)) AS k),
long AS (SELECT f.k, u.feature, CASE u.feature WHEN 'n_lines' THEN x1 ELSE x2 END AS x
         FROM rows_ JOIN f ON rows_.fold <> f.k, (SELECT unnest(['n_lines', 'sum_qty']) AS feature) u),
q AS (SELECT k, feature, quantile_cont(x, 0.5) AS center, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr
      FROM long GROUP BY k, feature)
SELECT CAST(k AS INTEGER) AS fold, feature, ROUND(center, 6) AS center,
       ROUND(CASE WHEN iqr = 0 THEN 1 ELSE iqr END, 6) AS scale FROM q""")
def q_fold_scalers(spark, d):
    from tabforge.operators.scale import fit_robust_scalers_by_fold
    got = fit_robust_scalers_by_fold(_rows(spark, d), FEATS, "fold", 5)
    return spark.createDataFrame(
        [(k, c, round(float(m.center[i]), 6), round(float(m.scale[i]), 6))
         for k, m in got.items() for i, c in enumerate(FEATS)],
        "fold int, feature string, center double, scale double")


# ----------------------------------------------------------------------------- K3

@register("linear_holdout", f"""
WITH {ROWS},
z AS (SELECT l_orderkey % 101 AS b, (x2 - med) / iqr AS x, y
      FROM rows_, (SELECT quantile_cont(x2, 0.5) AS med,
                          quantile_cont(x2, 0.75) - quantile_cont(x2, 0.25) AS iqr FROM rows_)),
h AS (SELECT r, x, y, ((1 + r) * b + 37 * r) % 101 < 50 AS held FROM z, (SELECT unnest(range(50)) AS r)),
tr AS (SELECT r, COUNT(*) AS n, AVG(x) AS mx, AVG(y) AS my, COUNT(*) * VAR_POP(x) AS g,
              COUNT(*) * COVAR_POP(x, y) AS c FROM h WHERE NOT held GROUP BY r),
w AS (SELECT r, mx, my, 'ridge' AS base, c / (g + 10) AS w FROM tr
      UNION ALL SELECT r, mx, my, 'lasso', SIGN(c) * GREATEST(ABS(c) - n * 0.01, 0) / g FROM tr),
e AS (SELECT base, r, SQRT(AVG(POWER(y - my - w * (x - mx), 2))) AS rmsle
      FROM h JOIN w USING (r) WHERE held GROUP BY base, r)
SELECT base, CAST(r AS INTEGER) AS repeat, ROUND(rmsle, 6) AS rmsle,
       ROUND(AVG(rmsle) OVER (PARTITION BY base), 6) AS mean,
       ROUND(VAR_POP(rmsle) OVER (PARTITION BY base), 8) AS variance,
       ROUND(STDDEV_POP(rmsle) OVER (PARTITION BY base), 6) AS stdev FROM e""")
def q_linear_holdout(spark, d):
    from tabforge.models.evaluate import linear_holdout
    rows = order_aggs(spark, d).select("l_orderkey", "sum_qty", "sum_price")
    per, summary = linear_holdout(rows, "l_orderkey", ["sum_qty"], "sum_price", fold_method="mod",
                                  grids={"ridge": ([10.0], None), "lasso": ([0.01], [1.0])})
    return per.join(F.broadcast(summary), "base").select(
        "base", "repeat", r6("rmsle").alias("rmsle"), r6("mean").alias("mean"),
        F.round("variance", 8).alias("variance"), r6("stdev").alias("stdev"))


_W = {"ridge": 0.15, "lasso": 0.15, "enet": 0.15, "bayes": 0.05, "stack": 0.35}
_BLEND_TERMS = " + ".join(f"{w} / 0.85 * (exp(my + w_{n} * (x2 - mx)) - 1)" for n, w in _W.items())


@register("predict_blend_one", f"""
WITH {ROWS},
s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(x2) AS mx, AVG(y) AS my, COUNT(*) * VAR_POP(x2) AS g,
             COUNT(*) * COVAR_POP(x2, y) AS c FROM rows_ WHERE fold <> 0),
w AS (SELECT mx, my, c / (g + 7) AS w_ridge, SIGN(c) * GREATEST(ABS(c) - n * 0.00143, 0) / g AS w_lasso,
             SIGN(c) * GREATEST(ABS(c) - n * 0.005, 0) / (g + n * 0.005) AS w_enet,
             c / (g + 1) AS w_bayes, c / (g + 100) AS w_stack FROM s),
b AS (SELECT l_orderkey, {_BLEND_TERMS} AS b FROM rows_, w WHERE fold = 0),
q AS (SELECT quantile_cont(b, 0.0042) AS lo, quantile_cont(b, 0.99) AS hi FROM b),
t1 AS (SELECT l_orderkey, CASE WHEN b > lo THEN b ELSE b * 0.77 END AS b, hi FROM b, q),
t2 AS (SELECT l_orderkey, CAST(TRUNC(CASE WHEN b < hi THEN b ELSE b * 1.1 END) AS BIGINT) AS v FROM t1)
SELECT l_orderkey, CASE WHEN (v % 1000) * 2 >= 1000 THEN v + 1000 - v % 1000 ELSE v - v % 1000 END AS prediction
FROM t2""")
def q_predict_blend_one(spark, d):
    from tabforge.models import linear as lin
    from tabforge.models.ensemble import EnsembleModel, StackModel, predict_blend
    from tabforge.models.gram import gram_stats
    rows = _rows(spark, d)
    x = ["sum_qty"]
    train = rows.where("fold <> 0")
    s = gram_stats(train, x, "y")
    ridge = {a: lin.fit_ridge(train, x, "y", a, stats=s) for a in (7.0, 1.0, 100.0)}
    linear = {"ridge": ridge[7.0], "lasso": lin.fit_lasso(train, x, "y", 0.00143, stats=s),
              "enet": lin.fit_elastic_net(train, x, "y", 0.01, 0.5, stats=s), "bayes": ridge[1.0]}
    model = EnsembleModel(x, linear, None, StackModel(x, {}, None, ridge[100.0]))
    return predict_blend(model, rows.where("fold = 0"), "l_orderkey")
