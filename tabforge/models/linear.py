"""Linear models solved from sufficient statistics (see ``gram``).

Objectives (``n`` rows, intercept not penalised, data centred per fit):

* ridge:        ||y - Xw - b||² + α ||w||²
* lasso:        1/(2n) ||y - Xw - b||² + α ||w||₁
* elastic net:  1/(2n) ||y - Xw - b||² + αρ ||w||₁ + α(1-ρ)/2 ||w||²
* Bayesian ridge: evidence maximisation (MacKay), Gamma(1e-6, 1e-6) priors.

Cross validation scores each candidate on each validation fold from that
fold's statistics: ridge by R² (mean over folds, the higher the better), the
L1 models by mean squared error.  The rows are read once, by ``gram_stats``; every fit is
then a ``d x d`` computation, on the driver or (the paths of the L1 searches) in tasks.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.models.gram import FoldStats, Stats, gram_stats
from tabforge.models.screening import cv_errors


class NotConverged(UserWarning):
    """An iteration limit was reached before the tolerance."""


#: Sweeps after which coordinate descent gives up, with a ``NotConverged`` warning.
MAX_SWEEPS = 100_000


@dataclass
class LinearModel:
    features: list[str]
    coef: np.ndarray
    intercept: float
    params: dict = field(default_factory=dict)

    def predict_expr(self) -> Column:
        """Prediction as one native expression (coefficients are literals)."""
        acc = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coef):
            if w != 0.0:
                acc = acc + qcol(c).cast("double") * F.lit(float(w))
        return acc

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.predict_expr())


# ----------------------------------------------------------------------------- solvers

def _intercept(s: Stats, w: np.ndarray) -> float:
    mx, my = s.means()
    return float(my - mx @ w)


def solve_ridge(s: Stats, alpha: float) -> tuple[np.ndarray, float]:
    g, c, _ = s.centered()
    w = np.linalg.solve(g + alpha * np.eye(s.d), c)
    return w, _intercept(s, w)


def enet_batch(g: np.ndarray, c: np.ndarray, l1: np.ndarray, l2: np.ndarray,
               w0: np.ndarray | None = None, tol: float = 1e-6,
               max_iter: int = MAX_SWEEPS) -> np.ndarray:
    """Coordinate descent for a batch of elastic-net problems at once.

    Problem ``b`` minimises ``½ wᵀG_b w - c_bᵀw + l1_b ||w||₁ + ½ l2_b ||w||²``
    (the centred least-squares objective times ``n``).  Every sweep updates
    coordinate ``j`` of all unconverged problems with numpy; a problem stops
    when its largest coefficient change is below ``tol`` times its largest
    coefficient; problems that have not stopped after ``max_iter`` sweeps give a
    ``NotConverged`` warning.
    """
    bsz, d = c.shape
    w = np.zeros((bsz, d)) if w0 is None else w0.astype(np.float64, copy=True)
    grad = c - np.einsum("bij,bj->bi", g, w)
    diag = np.einsum("bii->bi", g)
    active = np.arange(bsz)
    ga, da, wa, gr = g, diag, w, grad
    l1a, l2a = l1, l2
    den = da + l2a[:, None]
    safe = np.where(den > 0, den, 1.0)
    for _ in range(max_iter):
        if active.size == 0:
            break
        dmax = np.zeros(active.size)
        for j in range(d):
            old = wa[:, j]
            rho = gr[:, j] + da[:, j] * old
            new = np.where(den[:, j] > 0,
                           np.sign(rho) * np.maximum(np.abs(rho) - l1a, 0.0) / safe[:, j], 0.0)
            step = new - old
            gr -= ga[:, :, j] * step[:, None]
            wa[:, j] = new
            np.maximum(dmax, np.abs(step), out=dmax)
        wmax = np.abs(wa).max(axis=1)
        done = dmax <= tol * np.maximum(wmax, 1e-300)
        if done.any():
            w[active], grad[active] = wa, gr
            keep = ~done
            active = active[keep]
            ga, da, wa, gr = ga[keep], da[keep], wa[keep], gr[keep]
            l1a, l2a, den, safe = l1a[keep], l2a[keep], den[keep], safe[keep]
    if active.size:
        w[active] = wa
        warnings.warn(f"{active.size} of {bsz} problems did not converge in {max_iter} sweeps",
                      NotConverged, stacklevel=2)
    return w


def solve_enet(s: Stats, alpha: float, l1_ratio: float = 1.0, w0: np.ndarray | None = None,
               tol: float = 1e-6, max_iter: int = MAX_SWEEPS) -> tuple[np.ndarray, float]:
    """Elastic net (lasso at ``l1_ratio=1``) on one set of statistics."""
    g, c, _ = s.centered()
    n = s.n
    w = enet_batch(g[None], c[None], np.array([n * alpha * l1_ratio]),
                   np.array([n * alpha * (1.0 - l1_ratio)]),
                   None if w0 is None else w0[None], tol, max_iter)[0]
    return w, _intercept(s, w)


def solve_bayes_ridge(s: Stats, n_iter: int = 10_000, tol: float = 1e-3, shape: float = 1e-6,
                      rate: float = 1e-6) -> tuple[np.ndarray, float, float, float]:
    """``(coefficients, intercept, noise precision, weight precision)`` by evidence maximisation.

    In the eigenbasis of the centred Gram matrix the posterior mean divides each projection by
    ``eigenvalue + weight / noise precision``.  The number of well-determined directions then gives
    both precisions anew (each with a ``Gamma(shape, rate)`` prior), until the mean moves less than
    ``tol`` in sum; a ``NotConverged`` warning says that ``n_iter`` rounds did not suffice.
    """
    gram, cross, total = s.centered()
    size, basis = np.linalg.eigh(gram)
    size = np.maximum(size, 0.0)
    target = basis.T @ cross
    noise, weight = 1.0 / (total / s.n + np.finfo(np.float64).eps), 1.0

    def mean() -> np.ndarray:
        return basis @ (target / (size + weight / noise))

    before, now = None, mean()
    for _ in range(n_iter):
        determined = float((noise * size / (weight + noise * size)).sum())
        residual = float(total - 2 * now @ cross + now @ gram @ now)
        weight = (determined + 2 * shape) / (float(now @ now) + 2 * rate)
        noise = (s.n - determined + 2 * shape) / (residual + 2 * rate)
        if before is not None and np.abs(now - before).sum() < tol:
            break
        before, now = now, mean()
    else:
        warnings.warn(f"evidence not settled in {n_iter} rounds", NotConverged, stacklevel=2)
    now = mean()
    return now, _intercept(s, now), noise, weight


# ----------------------------------------------------------------------------- CV scoring

def _r2(val: Stats, w: np.ndarray, b: float) -> float:
    sse = val.sse(w, b)
    sst = val.sst()
    return 1.0 - sse / sst if sst > 0 else 0.0


def _mse(val: Stats, w: np.ndarray, b: float) -> float:
    return val.sse(w, b) / val.n


def ridge_cv(fs: FoldStats, alphas: Sequence[float]) -> tuple[float, list[float]]:
    """Best α by mean validation R² over the folds."""
    scores = []
    for a in alphas:
        r = [_r2(fs.folds[k], *solve_ridge(fs.train(k), a)) for k in fs.folds]
        scores.append(float(np.mean(r)))
    return float(alphas[int(np.argmax(scores))]), scores


def enet_cv(fs: FoldStats, alphas: Sequence[float], l1_ratios: Sequence[float] = (1.0,)
            ) -> tuple[float, float, np.ndarray]:
    """Best (α, ρ) by mean validation MSE over the folds; a Spark task per fold and ratio follows its
    path from the largest α down (see ``screening``)."""
    scores = cv_errors(fs, alphas, l1_ratios)
    i, j = np.unravel_index(int(np.argmin(scores)), scores.shape)
    return float(alphas[j]), float(l1_ratios[i]), scores


# ----------------------------------------------------------------------------- estimators

def _fit_stats(df: DataFrame, features: Sequence[str], label: str, fold: str | None,
               stats: FoldStats | None) -> FoldStats:
    return stats if stats is not None else gram_stats(df, features, label, fold)


def fit_ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0,
              stats: FoldStats | None = None) -> LinearModel:
    s = _fit_stats(df, features, label, None, stats).total()
    w, b = solve_ridge(s, alpha)
    return LinearModel(list(features), w, b, {"alpha": alpha})


def fit_lasso(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0,
              stats: FoldStats | None = None) -> LinearModel:
    s = _fit_stats(df, features, label, None, stats).total()
    w, b = solve_enet(s, alpha, 1.0)
    return LinearModel(list(features), w, b, {"alpha": alpha})


def fit_elastic_net(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0,
                    l1_ratio: float = 0.5, stats: FoldStats | None = None) -> LinearModel:
    s = _fit_stats(df, features, label, None, stats).total()
    w, b = solve_enet(s, alpha, l1_ratio)
    return LinearModel(list(features), w, b, {"alpha": alpha, "l1_ratio": l1_ratio})


def fit_bayes_ridge(df: DataFrame, features: Sequence[str], label: str,
                    stats: FoldStats | None = None, n_iter: int = 10_000) -> LinearModel:
    s = _fit_stats(df, features, label, None, stats).total()
    w, b, a, lam = solve_bayes_ridge(s, n_iter=n_iter)
    return LinearModel(list(features), w, b, {"alpha_": a, "lambda_": lam})


def fit_ridge_cv(df: DataFrame, features: Sequence[str], label: str, fold: str,
                 alphas: Sequence[float], stats: FoldStats | None = None) -> LinearModel:
    fs = _fit_stats(df, features, label, fold, stats)
    best, scores = ridge_cv(fs, alphas)
    w, b = solve_ridge(fs.total(), best)
    return LinearModel(list(features), w, b, {"alpha": best, "cv_r2": max(scores)})


def fit_lasso_cv(df: DataFrame, features: Sequence[str], label: str, fold: str,
                 alphas: Sequence[float], stats: FoldStats | None = None) -> LinearModel:
    fs = _fit_stats(df, features, label, fold, stats)
    best, _, scores = enet_cv(fs, alphas, (1.0,))
    w, b = solve_enet(fs.total(), best, 1.0)
    return LinearModel(list(features), w, b, {"alpha": best, "cv_mse": float(scores.min())})


def fit_elastic_net_cv(df: DataFrame, features: Sequence[str], label: str, fold: str,
                       alphas: Sequence[float], l1_ratios: Sequence[float],
                       stats: FoldStats | None = None) -> LinearModel:
    fs = _fit_stats(df, features, label, fold, stats)
    best_a, best_r, scores = enet_cv(fs, alphas, l1_ratios)
    w, b = solve_enet(fs.total(), best_a, best_r)
    return LinearModel(list(features), w, b,
                       {"alpha": best_a, "l1_ratio": best_r, "cv_mse": float(scores.min())})


def unscale(model: LinearModel, center: np.ndarray, scale: np.ndarray) -> LinearModel:
    """Express a model fitted on ``(x - center) / scale`` in terms of raw ``x``."""
    w = model.coef / scale
    b = model.intercept - float(np.sum(model.coef * center / scale))
    return LinearModel(model.features, w, b, dict(model.params))
