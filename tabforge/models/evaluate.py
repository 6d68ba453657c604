"""Repeated hold-out validation (the reference's dev loop).

Each repeat splits the training rows 50/50, fits on one half, predicts the other and scores RMSLE
on the raw labels; the repeats are summarised by mean, population variance and std.

``repeated_holdout`` fits the whole ensemble, a set of jobs per repeat.  ``linear_holdout`` fits
the linear bases alone and reads the rows once for all repeats: it takes sufficient statistics per
hash bucket of the key, and both halves of a repeat are sums of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.models import linear as lin
from tabforge.models.ensemble import (ENET_ALPHAS, ENET_L1_RATIOS, LASSO_ALPHAS, RIDGE_ALPHAS,
                                      EnsembleConfig, fit_ensemble, predict_blend)
from tabforge.models.gram import FoldStats, gram_stats
from tabforge.operators.folds import fold_expr, holdout
from tabforge.operators.metrics import error_summary, rmsle
from tabforge.operators.scale import fit_robust_scaler

#: Grids ``base: (alphas, l1 ratios)`` of ``linear_holdout``; ``bayes`` has none.
LINEAR_GRIDS = {"ridge": (RIDGE_ALPHAS, None), "lasso": (LASSO_ALPHAS, [1.0]),
                "enet": (ENET_ALPHAS, ENET_L1_RATIOS), "bayes": (None, None)}
#: Fixed values of the halves: hash buckets (a prime) and the shift per repeat.
BUCKETS, SHIFT = 101, 37


def repeated_holdout(train: DataFrame, key: str, features: Sequence[str], label: str,
                     repeats: int = 50, test_size: float = 0.5,
                     cfg: EnsembleConfig | None = None,
                     parallelism: int = 2) -> tuple[DataFrame, DataFrame]:
    """``(per-repeat errors, summary)``; ``label`` is the raw (unlogged) label.

    Repeats are independent, so ``parallelism`` of them are submitted at once.
    """
    spark = train.sparkSession

    def one(r: int) -> tuple[int, float]:
        tagged = holdout(train, key, test_size, seed=r + 1)
        dev = tagged.where(F.col("is_holdout") == 0).withColumn("_ylog", F.log1p(qcol(label)))
        val = tagged.where(F.col("is_holdout") == 1)
        model = fit_ensemble(dev, key, features, "_ylog", cfg)
        pred = predict_blend(model, val, key, "_pred")
        scored = pred.join(val.select(qcol(key), qcol(label)), key)
        return r, float(rmsle(scored, label, "_pred").first()["rmsle"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        errors = sorted(pool.map(one, range(repeats)))
    per = spark.createDataFrame(errors, "repeat int, rmsle double")
    return per, error_summary(per, "rmsle")


def held_buckets(repeat: int, test_size: float, buckets: int = BUCKETS) -> set[int]:
    """Buckets held out in a repeat: an affine map modulo the prime ``buckets`` orders them anew
    for each of the first ``buckets - 1`` repeats, and the first ``test_size`` of them go."""
    return {b for b in range(buckets)
            if ((1 + repeat) * b + SHIFT * repeat) % buckets < int(test_size * buckets)}


def linear_holdout(train: DataFrame, key: str, features: Sequence[str], label: str,
                   repeats: int = 50, test_size: float = 0.5, grids: dict | None = None,
                   cv_folds: int = 20, buckets: int = BUCKETS, seed: int = 42,
                   fold_method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """``(base, repeat, rmsle)`` and a summary per base, of linear bases fitted on ``log1p(label)``.

    ``grids`` names the bases and their search grids (default: all four at the reference's grids); a
    grid of one point is not searched, others by cross-validation over ``cv_folds`` groups of
    the half's buckets.  One robust scaler of all rows serves every repeat.  On the log scale the
    RMSLE of a linear base is its root mean squared error, which the held-out half's statistics give.
    The driver holds ``buckets`` matrices of ``features x features``.
    """
    if not 0 < repeats < buckets:
        raise ValueError(f"{repeats} repeats of {buckets} buckets; at most {buckets - 1}")
    feats, grids = list(features), grids or LINEAR_GRIDS
    rows = train.select(fold_expr(key, buckets, seed, fold_method).alias("_bucket"),
                        *[qcol(c) for c in feats], F.log1p(qcol(label).cast("double")).alias("_ylog"))
    scaler = fit_robust_scaler(rows, feats)
    stats = gram_stats(rows, feats, "_ylog", "_bucket")
    stats = FoldStats({b: s.scaled(scaler.center, scaler.scale) for b, s in stats.folds.items()})

    scores = []
    for r in range(repeats):
        held = held_buckets(r, test_size, buckets)
        kept = [b for b in sorted(stats.folds) if b not in held]
        if not kept or len(kept) == len(stats.folds):
            raise ValueError(f"repeat {r} leaves one half empty: {len(stats.folds)} buckets hold rows")
        place = {b: i % min(cv_folds, len(kept)) for i, b in enumerate(kept)}
        fit = FoldStats({b: stats.folds[b] for b in kept}).marginal(place.get)
        test = FoldStats({b: s for b, s in stats.folds.items() if b in held}).total()
        for base, (alphas, ratios) in grids.items():
            w, b = _fit_base(base, fit, alphas, ratios)
            scores.append((base, r, float(np.sqrt(max(0.0, test.sse(w, b)) / test.n))))
    per = train.sparkSession.createDataFrame(scores, "base string, repeat int, rmsle double")
    e = F.col("rmsle")
    return per, per.groupBy("base").agg(F.avg(e).alias("mean"), F.var_pop(e).alias("variance"),
                                        F.stddev_pop(e).alias("stdev"), F.count(e).alias("n"))


def _fit_base(base: str, fit: FoldStats, alphas, ratios) -> tuple[np.ndarray, float]:
    if base == "bayes":
        return lin.solve_bayes_ridge(fit.total())[:2]
    if ratios is None:
        alpha = alphas[0] if len(alphas) == 1 else lin.ridge_cv(fit, alphas)[0]
        return lin.solve_ridge(fit.total(), alpha)
    alpha, ratio = ((alphas[0], ratios[0]) if len(alphas) * len(ratios) == 1
                    else lin.enet_cv(fit, alphas, ratios)[:2])
    return lin.solve_enet(fit.total(), alpha, ratio)
